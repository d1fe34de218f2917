"""Catalog tables bucketed by their merge keys.

A final table that is merged into every run is stored bucketed on the merge
keys. Reading it back, Spark knows its hash partitioning, so the MERGE's
full outer join shuffles only the (small) incoming batch to the table's
bucket layout; the large target is read in place, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """Write ``df`` as a Parquet catalog table bucketed and sorted by ``keys``.
    Size ``buckets`` so one bucket file stays near the target file size
    (e.g. total bytes / 256 MB), and keep it stable across runs."""
    (
        df.write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def swap_in(spark: SparkSession, new_state: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Replace ``table`` by a new state computed from it: the state is written
    to a staging table first (Spark cannot overwrite a table it reads), the old
    one is renamed aside, the new one takes its name, and only then the old one
    goes. If a run ends between the two renames, the next one puts the old table
    back first (:func:`recover`)."""
    staging, old = f"{table}__next", f"{table}__old"
    recover(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    save_bucketed(new_state, staging, keys, buckets)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a swap that was cut short."""
    old = f"{table}__old"
    if spark.catalog.tableExists(old):
        spark.sql(f"DROP TABLE {old}" if spark.catalog.tableExists(table) else f"ALTER TABLE {old} RENAME TO {table}")
