"""Tables partitioned by a hash of their merge keys, merged where a batch
touches them.

A row lies in the partition ``key_bucket`` of its keys, so a batch names the
partitions that can hold its keys: those are read, merged and overwritten, the
others are neither read nor written. The work of a merge follows the batch and
the number of buckets that it touches, not the table.

A row with a NULL key matches nothing and is only ever inserted. It lies in
bucket -1, in a partition of its own batch (``key_batch``), so that replaying a
batch overwrites what it inserted before. Overwriting is by partition and moved
into place at the end of the job; a merge that fails half way is completed by
its replay, which gives the same table.

``key_order`` holds the incremental column in microseconds: Parquet keeps its
extremes in the footers, and :func:`footer_max` reads the watermark from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import merge as M
from tidewater.session import scratch_path

BUCKET, BATCH, ORDER = "key_bucket", "key_batch", "key_order"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lies and how: ``buckets`` is fixed for the table's life,
    about its size / 256 MB."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int
    order_col: str | None = None

    def bucket(self) -> Column:
        """The bucket of a row's keys, -1 if one is NULL. Keys are hashed in
        the table's types, so a batch finds them whatever its own are."""
        typed = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        unknown = reduce(lambda a, b: a | b, [c.isNull() for c in typed])
        return F.when(unknown, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*typed), F.lit(self.buckets)).cast("int"))


def _write(table: KeyedTable, rows: DataFrame, batch_id: str) -> None:
    order = F.unix_micros(F.col(table.order_col).cast("timestamp")) if table.order_col else F.lit(None).cast("long")
    placed = rows.select(*table.schema.fieldNames(), order.alias(ORDER), table.bucket().alias(BUCKET))
    placed = placed.withColumn(BATCH, F.when(F.col(BUCKET) < 0, F.lit(batch_id)).otherwise(F.lit("keyed")))
    (
        placed.repartition(BUCKET)  # a bucket is one file, of a bounded share of the keys
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET, BATCH)
        .parquet(table.path)
    )


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int, order_col: str | None = None) -> KeyedTable:
    table = KeyedTable(path, df.schema, tuple(keys), buckets, order_col)
    _write(table, df, "first")
    return table


def _stored(table: KeyedTable) -> T.StructType:
    placed = [T.StructField(ORDER, T.LongType()), T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.StringType())]
    return T.StructType([*table.schema.fields, *placed])


def _files(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return spark.read.schema(_stored(table)).parquet(table.path)


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _files(spark, table).select(*table.schema.fieldNames())


def merge_batch(table: KeyedTable, batch: DataFrame, batch_id: str) -> list[int]:
    """Upsert ``batch``, at most one row per key, with all columns of the
    table; returns the buckets that were read and written. ``batch_id`` tells
    batches apart: the same id again replaces the rows without a key that it
    inserted before."""
    if batch_id in ("first", "keyed") or not batch_id:
        raise ValueError(f"{batch_id!r} can't be the id of a batch")
    spark = batch.sparkSession
    path = scratch_path(spark, "keyed-batch")
    typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    typed.withColumn(BUCKET, table.bucket()).write.parquet(path)  # evaluated once
    landed = spark.read.parquet(path)
    touched = sorted(r[0] for r in landed.select(BUCKET).distinct().collect())  # at most one row per bucket
    if not touched:
        return []
    keyed = [b for b in touched if b >= 0]
    old = _files(spark, table).filter(F.col(BUCKET).isin(keyed)).select(*table.schema.fieldNames())
    rows = landed.drop(BUCKET)
    _write(table, M.merge_upsert(old, rows, table.keys), batch_id)
    return touched


def footer_max(spark: SparkSession, path: str, col: str, schema: T.StructType | None = None) -> tuple[object, str]:
    """The greatest value of an integer or date column, from the footers of the
    Parquet files alone: the aggregate is pushed into the reader, and no column
    is read. None for a table without values; the plan comes second."""
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        found = reader.parquet(path).agg(F.max(col))
        return found.collect()[0][0], found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def watermark(spark: SparkSession, table: KeyedTable) -> Column | None:
    """The greatest value of the order column as a literal; None without rows."""
    micros, _ = footer_max(spark, table.path, ORDER, _stored(table))
    return None if micros is None else order_literal(table, micros)


def order_literal(table: KeyedTable, micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros)).cast(table.schema[table.order_col].dataType)
