"""Queries of the weekly usage export: epoch units, week filter, exact
N-row parts, manifest, CSV shards."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fixtures as fx
from tidewater.functions import time as TM
from tidewater.operators import chunk, filters
from tidewater.plans import jobs, q_curation, windows
from tidewater.plans.registry import register
from tidewater.session import scratch_path
from tidewater.sinks import files, parts
from tidewater.sources import csv_records

TODAY = date(2024, 1, 23)  # a Tuesday: the week is [2024-01-16, 2024-01-23)
WEEK_START, WEEK_END = windows.weekly_window(TODAY)
ZONE = "UTC"
ROWS_PER_PART = 1000
CURATED_ROWS_PER_PART = 100
BATCH_ID = "2024-01-23-08-00-00"

_USAGE_SQL = """
usage as (select event_id, user_id, event_type,
  case when event_id % 2 = 0 then epoch_us(ts) // 1000 else epoch_us(ts) // 1000000 end as "timestamp" from events)"""
_AUTO = """case when "timestamp" is null then null when "timestamp" >= 1000000000000 then make_timestamp("timestamp" * 1000)
 else make_timestamp("timestamp" * 1000000) end"""
_WEEK_SQL = f"""
week as (select * from usage where {_AUTO} >= timestamp '{WEEK_START} 00:00:00' and {_AUTO} < timestamp '{WEEK_END} 00:00:00')"""
_PARTS_SQL = f"""
parts as (select *, row_number() over (order by event_id) - 1 as row_index,
  cast((row_number() over (order by event_id) - 1) // {ROWS_PER_PART} + 1 as integer) as part_no from usage)"""
# The weekly export of the curated tracking table.
_CURATED_PARTS_SQL = f"""
curated as ({q_curation._CURATED_SQL}),
parts as (select "timestamp", cast((row_number() over (order by "timestamp") - 1) // {CURATED_ROWS_PER_PART} + 1 as integer) as part_no
  from curated where make_timestamp("timestamp" * 1000) >= timestamp '{WEEK_START} 00:00:00'
   and make_timestamp("timestamp" * 1000) < timestamp '{WEEK_END} 00:00:00')"""
_MANIFEST_SQL = f"""
select '{BATCH_ID}' as batch_id, count(*) over () as expected_file_count,
 printf('usage_events_part_%03d.csv', part_no::bigint) as file_name, row_count,
 min(mn) over () as min_event_timestamp, max(mx) over () as max_event_timestamp
from (select part_no, count(*)::bigint as row_count, min("timestamp") mn, max("timestamp") mx from parts group by part_no)"""

USAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def usage_events(spark, sf):
    """Usage rows whose integer ``timestamp`` is epoch milliseconds for even
    ids and epoch seconds for odd ids (the export sees both units)."""
    ev = fx.table(spark, sf, "events")
    ts = F.when(F.col("event_id") % 2 == 0, TM.unix_millis_ntz(F.col("ts"))).otherwise(TM.epoch_seconds_ntz(F.col("ts")))
    return ev.select("event_id", "user_id", "event_type", ts.alias("timestamp"))


def usage_table(spark, sf):
    """The usage rows as the stored table the export reads (written once per
    run to the shared folder), so the week predicate reaches the scan."""
    path = scratch_path(spark, "usage-table")
    usage_events(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def week_rows(spark, sf):
    return filters.filter_local_week(usage_table(spark, sf), "timestamp", WEEK_START, WEEK_END, ZONE)


@register(
    "epoch_auto_unit",
    "with " + _USAGE_SQL + f' select event_id, "timestamp", {_AUTO} as event_ts from usage',
)
def q_epoch_auto_unit(spark, sf):
    """Integer epoch -> timestamp: >= 1e12 is milliseconds, else seconds."""
    u = usage_events(spark, sf)
    return u.select("event_id", "timestamp", TM.epoch_auto_unit(F.col("timestamp")).alias("event_ts"))


@register(
    "unix_seconds_to_datetime",
    "select o_orderkey, epoch_us(o_orderdate) // 1000000 as epoch_s, "
    "make_timestamp((epoch_us(o_orderdate) // 1000000) * 1000000) as placed_at from orders",
)
def q_unix_seconds_to_datetime(spark, sf):
    """``DATETIME(TIMESTAMP_SECONDS(CAST(c AS INT64)))`` on a unix-seconds column."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", TM.epoch_seconds_ntz(F.col("o_orderdate")).alias("epoch_s"))
    return o.withColumn("placed_at", TM.seconds_to_ntz(F.col("epoch_s")))


@register("filter_local_week", "with " + _USAGE_SQL + "," + _WEEK_SQL + " select * from week")
def q_filter_local_week(spark, sf):
    """Week ``[latest Tuesday - 7 days, latest Tuesday)`` over both epoch units,
    as range predicates on the raw integer."""
    return week_rows(spark, sf)


def usage_parts(spark, sf):
    return chunk.chunk_rows_to_parts(usage_table(spark, sf), [("event_id", "asc")], ROWS_PER_PART)


@register("chunk_rows_to_parts", "with " + _USAGE_SQL + "," + _PARTS_SQL + " select * from parts")
def q_chunk_rows_to_parts(spark, sf):
    """Exact parts of 1,000 rows in id order, the last one shorter."""
    return usage_parts(spark, sf)


@register("agg_export_manifest", "with " + _USAGE_SQL + "," + _PARTS_SQL + _MANIFEST_SQL)
def q_agg_export_manifest(spark, sf):
    """Per part row counts; global min / max of the raw (mixed-unit) timestamp."""
    return chunk.export_manifest(usage_parts(spark, sf), "timestamp", BATCH_ID)


@register("job_usage_export", "with " + _CURATED_PARTS_SQL + _MANIFEST_SQL)
def q_job_usage_export(spark, sf):
    """Tracking events curated into the 26-column table -> its week -> exact
    parts -> named part files and ``metadata.json``; returns the manifest's
    rows."""
    path = scratch_path(spark, "curated-table")
    jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf)).write.parquet(path)
    out = jobs.usage_export(spark.read.parquet(path), TODAY, ZONE, CURATED_ROWS_PER_PART, scratch_path(spark, "usage-export"), BATCH_ID)
    return parts.manifest_rows(spark, out)


@register(
    "export_parts_with_manifest",
    "with " + _USAGE_SQL + "," + _PARTS_SQL
    + " select event_id, user_id, event_type, \"timestamp\", "
    "printf('usage_events_part_%03d.csv', part_no::bigint) as file_name from parts",
)
def q_export_parts_with_manifest(spark, sf):
    """Parts written as one CSV file each under its own name, read back: every
    row lies in the file named for its part."""
    out = scratch_path(spark, "usage-parts")
    parts.export_parts(usage_parts(spark, sf), out, USAGE_SCHEMA.fieldNames(), "timestamp", BATCH_ID)
    return csv_records.read_csv(spark, out + "/*.csv", USAGE_SCHEMA)


@register("export_week", "with " + _USAGE_SQL + "," + _WEEK_SQL + " select * from week")
def q_export_week(spark, sf):
    """The week's rows exported as gzip CSV with header to
    ``week_start=../week_end=..``, read back."""
    out = files.export_week(week_rows(spark, sf), scratch_path(spark, "usage-week"), str(WEEK_START), str(WEEK_END))
    return csv_records.read_csv(spark, out, USAGE_SCHEMA).drop("file_name")


@register("scan_export_shards", "with " + _USAGE_SQL + " select * from usage")
def q_scan_export_shards(spark, sf):
    """Exported CSV shards (gzip, with header) read back in one scan; rows
    with no non-empty cell are dropped."""
    rows = usage_table(spark, sf)
    blanks = rows.filter(F.col("event_id") % 53 == 0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in USAGE_SCHEMA.fields]
    )
    out = files.export_week(rows.unionByName(blanks), scratch_path(spark, "usage-shards"), str(WEEK_START), str(WEEK_END))
    shards = csv_records.read_csv(spark, out, USAGE_SCHEMA).drop("file_name")
    return filters.filter_blank_rows(shards)


@register(
    "filter_blank_rows",
    """select * from (select case when event_id % 5 = 0 then null else event_type end as a,
  case when event_id % 3 = 0 then '' else cast(user_id as varchar) end as b,
  case when event_id % 2 = 0 then null else cast(event_id as varchar) end as c from events)
 where coalesce(a, '') <> '' or coalesce(b, '') <> '' or coalesce(c, '') <> ''""",
)
def q_filter_blank_rows(spark, sf):
    """Keep rows with any non-empty cell (NULL and '' are empty)."""
    ev = fx.table(spark, sf, "events")
    df = ev.select(
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("a"),
        F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("b"),
        F.when(F.col("event_id") % 2 == 0, F.lit(None)).otherwise(F.col("event_id").cast("string")).alias("c"),
    )
    return filters.filter_blank_rows(df)


RUN_NOW = datetime(2024, 1, 11, 10, 0, 0)
