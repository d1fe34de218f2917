"""Exact N-row parts in a global order, computed in parallel.

A global ``row_number()`` without ``PARTITION BY`` moves every row into one
task. Instead:

1. range-partition on the total order, sort within partitions and land the
   rows with their range and their place in it, so that both are fixed even if
   executors are lost and tasks re-run; the number of ranges follows from the
   size of the data (AQE merges small ones);
2. count rows per range -- one small row per range, from one landed column;
3. prefix sums on two levels: over groups of ranges, and over the ranges of
   each group. They are kept as a table and joined, so neither the plan nor the
   driver holds a number per range;
4. row index = offset of the range + place in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.dedupe import OrderSpec, order_columns
from tidewater.session import scratch_path

_POS_BITS = 33


def _sort_cols(df: DataFrame, order_by: OrderSpec) -> list[Column]:
    spec = [(c, "asc") if isinstance(c, str) else c for c in order_by]
    cols = order_columns(df, spec, [], tie_break=True)
    return cols


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def range_offsets(counts: DataFrame, group_size: int = 1024) -> DataFrame:
    """``(__range, __offset)``: the rows before each range, of ``(__range,
    __n)``. Only the sums of groups of ranges are summed up in one task."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(before(w)), F.lit(0))
    grouped = counts.withColumn("__group", F.floor(F.col("__range") / group_size))
    groups = grouped.groupBy("__group").agg(F.sum("__n").alias("__all"))
    bases = groups.select("__group", sum_of("__all", Window.orderBy("__group")).alias("__base"))
    inside = sum_of("__n", Window.partitionBy("__group").orderBy("__range"))
    offsets = grouped.withColumn("__inside", inside).join(bases, "__group")
    return offsets.select("__range", (F.col("__base") + F.col("__inside")).cast("bigint").alias("__offset"))


def with_row_index(
    df: DataFrame, order_by: OrderSpec, num_partitions: int | None = None, index_col: str = "row_index"
) -> DataFrame:
    """Add a 0-based, gap-free ``index_col`` following ``order_by`` (ties
    broken by all remaining columns)."""
    cols = _sort_cols(df, order_by)
    ranged = df.repartitionByRange(*([num_partitions] if num_partitions else []), *cols).sortWithinPartitions(*cols)
    place = F.monotonically_increasing_id()
    rows = _landed(
        ranged.withColumn("__place", place).select(
            "*", F.shiftright("__place", _POS_BITS).alias("__range")
        ).withColumn("__place", F.col("__place") - F.shiftleft("__range", _POS_BITS)),
        "row-index",
    )
    offsets = _landed(range_offsets(rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))), "row-index-offsets")
    return rows.join(offsets, "__range").select(*df.columns, (F.col("__offset") + F.col("__place")).alias(index_col))


def chunk_rows_to_parts(
    df: DataFrame,
    order_by: OrderSpec,
    rows_per_part: int,
    num_partitions: int | None = None,
    part_col: str = "part_no",
) -> DataFrame:
    """Parts of exactly ``rows_per_part`` rows in ``order_by`` order (the last
    part shorter); parts are numbered from 1. No rows -> no parts."""
    if rows_per_part <= 0:
        raise ValueError("rows_per_part must be positive")
    indexed = with_row_index(df, order_by, num_partitions)
    return indexed.withColumn(part_col, (F.floor(F.col("row_index") / F.lit(rows_per_part)) + 1).cast("int"))


# Fixed value: part file names of the weekly usage export.
PART_PREFIX, PART_WIDTH, PART_SUFFIX = "usage_events_part_", 3, ".csv"


def part_file_name(part_col: Column, prefix: str = PART_PREFIX, width: int = PART_WIDTH, suffix: str = PART_SUFFIX) -> Column:
    """``usage_events_part_001.csv`` style names from the part number; longer
    numbers take more digits."""
    return F.format_string(f"{prefix}%0{width}d{suffix}", part_col.cast("long"))


def export_manifest(
    parts: DataFrame,
    ts_col: str,
    batch_id: str,
    part_col: str = "part_no",
) -> DataFrame:
    """One row per part file: its name and row count, with the batch id, the
    file count and the global min / max of the raw timestamp column (units as
    stored, not normalised). Per-part counts are a partial-then-final
    aggregate; the batch totals are one scalar subquery (parts are numbered
    1..n, so the file count is the largest part number). No step gathers the
    parts into one task."""
    per_part = parts.groupBy(part_col).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
    totals = parts.agg(
        F.struct(
            F.max(part_col).cast("bigint").alias("n"),
            F.min(ts_col).alias("lo"),
            F.max(ts_col).alias("hi"),
        ).alias("t")
    ).scalar()
    return per_part.select(
        F.lit(batch_id).alias("batch_id"),
        totals.getField("n").alias("expected_file_count"),
        part_file_name(F.col(part_col)).alias("file_name"),
        "row_count",
        totals.getField("lo").alias("min_event_timestamp"),
        totals.getField("hi").alias("max_event_timestamp"),
    )


def concat_parts(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
