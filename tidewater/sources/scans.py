"""Table scans: incremental window, full snapshot, above-watermark, day slices.

A scan is a plain ``spark.read`` plus a filter on the raw incremental column,
so the bounds arrive in the Parquet reader as ``PushedFilters`` (or in a
JDBC source as a WHERE clause and partition stride).
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import time as TM


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    inc_col: str | None = None,
    lower: datetime | None = None,
    upper: datetime | None = None,
    num_partitions: int = 8,
    fetch_size: int = 10_000,
    **options,
) -> DataFrame:
    """Relational source over Spark's JDBC reader. With an incremental column
    and both bounds, the read is split into ``num_partitions`` parallel range
    queries on that column; the window predicate itself is applied with
    :func:`scan_incremental_window` and pushed into each query."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if inc_col and lower is not None and upper is not None:
        reader = (
            reader.option("partitionColumn", inc_col)
            .option("lowerBound", lower.isoformat(sep=" "))
            .option("upperBound", upper.isoformat(sep=" "))
            .option("numPartitions", num_partitions)
        )
    return reader.options(**options).load()


def scan_incremental_window(
    df: DataFrame, inc_col: str | None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows with ``inc > start AND inc <= end``; either bound optional. No
    incremental column, or no bounds at all, means the full table."""
    if inc_col is None or (start is None and end is None):
        return df
    return df.filter(TM.instant_range(F.col(inc_col), start, end, df.schema[inc_col].dataType, closed="right"))


def scan_full_snapshot(df: DataFrame) -> DataFrame:
    return df


def scan_above_watermark(
    df: DataFrame,
    inc_col: str,
    final: DataFrame | None,
    final_col: str,
    lookback_seconds: int = 0,
    explicit_start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Open-ended scan from ``MAX(final.col) - lookback``. An explicit start
    wins and is not shifted by the lookback. Without a final table (first
    load) or an empty one, the whole table is read.

    The watermark is a scalar subquery: executed once, reused by every task,
    and handed to the Parquet reader as a runtime filter.
    """
    col = F.col(inc_col)
    dtype = df.schema[inc_col].dataType
    if explicit_start is not None:
        out = df.filter(TM.instant_range(col, explicit_start, None, dtype, closed="right"))
    elif final is None:
        out = df
    else:
        wm = final.agg(F.max(final_col).alias("wm")).scalar()
        if lookback_seconds:
            wm = wm - F.make_dt_interval(secs=F.lit(lookback_seconds))
        out = df.filter(wm.isNull() | (col > wm))
    if end is not None:
        out = out.filter(TM.instant_range(col, None, end, dtype, closed="right"))
    return out


def scan_day_slices(
    df: DataFrame, ts_col: str, start: date | str, end: date | str, tag_col: str = "_window_date"
) -> DataFrame:
    """One slice per day of the inclusive range ``[start, end]``, each row
    tagged with its day. One scan with a pushed range, not a loop of reads;
    on a day-partitioned landing zone the same predicate prunes partitions."""
    start_d = date.fromisoformat(start) if isinstance(start, str) else start
    end_d = date.fromisoformat(end) if isinstance(end, str) else end
    lo = datetime.combine(start_d, datetime.min.time())
    hi = datetime.combine(end_d + timedelta(days=1), datetime.min.time())
    dtype = df.schema[ts_col].dataType
    return df.filter(TM.instant_range(F.col(ts_col), lo, hi, dtype, closed="left")).withColumn(
        tag_col, F.to_date(F.col(ts_col))
    )


def read_day_partitions(
    spark: SparkSession, root: str, start: date | str, end: date | str, day_col: str = "day", fmt: str = "parquet"
) -> DataFrame:
    """Read a landing zone laid out as ``root/day=YYYY-MM-DD/``; the BETWEEN
    predicate on the partition column prunes directories at planning time."""
    df = spark.read.format(fmt).load(root)
    return df.filter(F.col(day_col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None when it does not exist yet (first load:
    no watermark, the whole source is read)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.format(fmt).load(path) if fs.exists(hpath) else None


def max_watermark(final: DataFrame | None, col: str) -> DataFrame | None:
    """``MAX(col)`` of the final table as a one-row DataFrame (use
    ``.scalar()`` inside a plan); None for a missing table."""
    return None if final is None else final.agg(F.max(col).alias("watermark"))
