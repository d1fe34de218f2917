"""Queries of run windows, bookmarks and the streaming re-aims."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.operators import dedupe, filters, project, records
from tidewater.plans import q_merge, windows
from tidewater.plans.registry import register
from tidewater.session import scratch_path
from tidewater.sinks import keyed
from tidewater.sources import ndjson, scans
from tidewater.streaming import microbatch

NOW = datetime(2024, 1, 11, 10, 0, 0)  # the scheduler's clock for these runs (UTC)


def _events(spark, sf):
    return fx.table(spark, sf, "events")


def _utc_of_local(day: str, zone: str) -> str:
    return f"timezone('UTC', timezone('{zone}', timestamp '{day} 00:00:00'))"


@register(
    "window_previous_local_day",
    f"select * from events where ts > {_utc_of_local('2024-01-10', 'America/Lima')} "
    f"and ts <= {_utc_of_local('2024-01-11', 'America/Lima')}",
)
def q_window_previous_local_day(spark, sf):
    """``(midnight D-1, midnight D]`` in America/Lima for a run at NOW."""
    w = windows.previous_local_day(NOW)
    return scans.scan_incremental_window(_events(spark, sf), "ts", w.start, w.end)


@register(
    "window_trailing_minutes",
    "select * from events where ts > timestamp '2024-01-11 09:30:00' and ts <= timestamp '2024-01-11 10:00:00'",
)
def q_window_trailing_minutes(spark, sf):
    """``(now - 30 min, now]``."""
    w = windows.trailing_minutes(NOW, 30)
    return scans.scan_incremental_window(_events(spark, sf), "ts", w.start, w.end)


@register("window_explicit_or_watermark", "select * from orders where o_orderdate > timestamp '2001-06-01'")
def q_window_explicit_or_watermark(spark, sf):
    """An explicit start wins over the watermark and is not shifted by the
    lookback; the end stays open."""
    w = windows.resolve_replication_window(
        NOW, watermark=datetime(1999, 12, 31), explicit_start=datetime(2001, 6, 1), lookback_seconds=3600
    )
    return scans.scan_incremental_window(fx.table(spark, sf, "orders"), "o_orderdate", w.start, w.end)


_BOOKMARKS_SQL = """
bm as (select event_type as stream, 'event_date' as field, max(cast(ts as date)) as value
  from events where ts < timestamp '2024-01-19' group by event_type)"""


def bookmarks(spark, sf):
    """Bookmark table: per stream (event type) the last loaded event date."""
    ev = _events(spark, sf).filter(F.col("ts") < F.lit("2024-01-19").cast("timestamp_ntz"))
    return ev.groupBy(F.col("event_type").alias("stream")).agg(
        F.lit("event_date").alias("field"), F.max(F.to_date("ts")).alias("value")
    )


@register(
    "window_bookmark_lookback",
    "with " + _BOOKMARKS_SQL + """
select e.* from events e
 where cast(e.ts as date) >= greatest(date '2024-01-15', (select value from bm where stream = 'click'))
   and cast(e.ts as date) <= date '2024-01-20' and e.event_type = 'click'""",
)
def q_window_bookmark_lookback(spark, sf):
    """Start = max(run date - 5 days, bookmark) with the bookmark day re-read;
    end = run date; inclusive days."""
    run_date, lookback = date(2024, 1, 20), 5
    bm = windows.bookmark_value(bookmarks(spark, sf), "click", "event_date").scalar()
    floor = F.lit(str(date.fromordinal(run_date.toordinal() - lookback))).cast("date")
    start = F.greatest(floor, F.coalesce(bm, floor))
    ev = _events(spark, sf).filter(F.col("event_type") == "click")
    # Bounds on the raw column reach the scan.
    kind = ev.schema["ts"].dataType
    end = F.lit(str(date.fromordinal(run_date.toordinal() + 1))).cast(kind)
    return ev.filter((F.col("ts") >= floor.cast(kind)) & (F.col("ts") >= start.cast(kind)) & (F.col("ts") < end))


@register(
    "advance_bookmark",
    "with " + _BOOKMARKS_SQL + """
select stream, field, value from bm where stream <> 'click'
union all select 'click', 'event_date', date '2024-01-17'""",
)
def q_advance_bookmark(spark, sf):
    """Bookmark set to the window end unconditionally -- here it moves
    backwards, as the source job allows."""
    return windows.advance_bookmark(bookmarks(spark, sf), "click", "event_date", "2024-01-17")


MERGE_BUCKETS = 16


def _land_orders_raw_by_range(spark, sf, newest_first: bool = False) -> str:
    """Raw staging rows landed as files in time order, or against it: three
    ranges, each of several files."""
    raw = fx.orders_raw(spark, sf)
    root = scratch_path(spark, "orders-raw-stream")
    cuts = ["1999-12-31", "2000-06-01", "2001-01-01", "2100-01-01"]
    for lo, hi in sorted(zip(cuts, cuts[1:]), reverse=newest_first):
        lo, hi = (F.lit(c).cast("timestamp_ntz") for c in (lo, hi))
        part = raw.filter((F.col("updatedAt") >= lo) & (F.col("updatedAt") < hi))
        part.repartition(2).write.mode("append").parquet(root)
    return root


def _keyed_orders(spark, sf):
    return keyed.create(fx.orders_final(spark, sf), scratch_path(spark, "orders-keyed"), ["id"], MERGE_BUCKETS, "updated_at")


def _prepared(batch, mark):
    staged = filters.filter_above(batch, "updatedAt", mark)
    return dedupe.dedupe_latest(project.project_snake_case(staged), ["id"], [("updated_at", "desc")])


@register("stream_merge_microbatch", q_merge._UPSERT_SQL)
def q_stream_merge_microbatch(spark, sf):
    """The 30-minute replication as a stream: each micro-batch (two landed
    files) goes through late filter -> snake_case -> keep-latest -> MERGE into
    the key partitions it touches. Equals the one-shot merge."""
    src, table = _land_orders_raw_by_range(spark, sf), _keyed_orders(spark, sf)
    return microbatch.merge_stream(spark, src, fx.orders_raw(spark, sf).schema, table, _prepared, max_files_per_trigger=2)


@register("stream_keep_latest", q_merge._UPSERT_SQL)
def q_stream_keep_latest(spark, sf):
    """The same input as keyed state of the stream, files of the newest range
    first: rows that arrive out of order change nothing in the outcome."""
    src, table = _land_orders_raw_by_range(spark, sf, newest_first=True), _keyed_orders(spark, sf)
    raw = fx.orders_raw(spark, sf).schema
    return microbatch.latest_stream(spark, src, raw, table, project.project_snake_case, ["updated_at"], max_files_per_trigger=2)


@register("merge_upsert_scoped", q_merge._UPSERT_SQL)
def q_merge_upsert_scoped(spark, sf):
    """One batch merged into a table partitioned by a hash of its keys."""
    table = _keyed_orders(spark, sf)
    keyed.merge_batch(table, _prepared(fx.orders_raw(spark, sf), keyed.watermark(spark, table)), "run-1")
    return keyed.read(spark, table)


@register("footer_watermark", q_merge._OF + "select max(updated_at) as watermark from fx_orders_final")
def q_footer_watermark(spark, sf):
    """``MAX(updated_at)`` from the footers of the keyed table."""
    table = _keyed_orders(spark, sf)
    return spark.range(1).select(keyed.watermark(spark, table).alias("watermark"))


@register(
    "stream_dedupe_events",
    "with " + __import__("tidewater.plans.q_semistructured", fromlist=["x"]).NPS_CTES
    + " select distinct event_id from nps_rows where event_id is not null",
)
def q_stream_dedupe_events(spark, sf):
    """NDJSON export files as a stream -> NPS rows -> first row per event id
    within a 31-day watermark (longer than the input's disorder)."""
    from tidewater.plans.q_semistructured import INGESTED_AT, RUN_DATE, land_feed

    path = land_feed(spark, sf, with_junk=True)
    lines = spark.readStream.format("text").load(path).withColumnRenamed("value", "line")
    rows = records.nps_rows(ndjson.json_objects(lines), RUN_DATE, INGESTED_AT)
    rows = filters.filter_key_not_null(rows, "event_id")
    out, checkpoint = (scratch_path(spark, f"nps-dedupe-{x}") for x in ("rows", "checkpoint"))
    out = microbatch.dedupe_stream(rows.select("event_id", "event_timestamp"), "event_id", "event_timestamp", "31 days", out, checkpoint)
    return out.select("event_id")
