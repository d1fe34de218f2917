"""Composite jobs: the end-to-end flows, each one lazy DataFrame plan from
scan to resulting table state. Writing is left to ``tidewater.sinks``."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import time as TM
from tidewater.functions import types as TY
from tidewater.functions.contract import TRACKING_CONTRACT, EventContract
from tidewater.operators import chunk, dedupe, filters, joins, merge, project, records, replace, schema
from tidewater.plans.configs import AdsStream, TableConfig
from tidewater.plans import windows
from tidewater.session import scratch_path
from tidewater.sinks import files, parts
from tidewater.sources import csv_declared, ndjson, pages, scans

TRACKING_ZONE = "America/Chicago"


def curate_tracking(
    events: DataFrame,
    users: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    zone: str = TRACKING_ZONE,
    contract: EventContract = TRACKING_CONTRACT,
) -> DataFrame:
    """Local-day window -> name set, one flag, contract -> join eligible
    subscribers -> curated 26-column layout. Without bounds, all days."""
    ev = events
    if start is not None and end is not None:
        ev = filters.filter_local_day(ev, "event_timestamp", start, end, zone)
    ev = filters.filter_event_contract(ev, contract)
    return project.project_tracking_columns(joins.join_events_subscribers(ev, users))


def tracking_day(
    target: DataFrame,
    events: DataFrame,
    users: DataFrame,
    start: date | str,
    end: date | str,
    zone: str = TRACKING_ZONE,
) -> DataFrame:
    """Daily refresh: rebuild the local day and replace it in the target."""
    rebuilt = curate_tracking(events, users, start, end, zone)
    return replace.replace_local_day(target, rebuilt, "timestamp", start, end, zone)


def replicate_table(
    source: DataFrame,
    final: DataFrame | None,
    cfg: TableConfig,
    run_ts: datetime,
    start: datetime | None = None,
    end: datetime | None = None,
    late_policy: str = "drop",
    source_types: dict | None = None,
) -> DataFrame:
    """Window scan -> stamp ``_loaded_at`` -> late filter -> snake_case and
    typed projection -> reconcile the final schema -> keep-latest -> MERGE.

    Returns the new state of the final table. A snapshot config (no
    incremental column) reads everything and deletes keys missing from the
    snapshot.
    """
    scanned = scans.scan_incremental_window(source, cfg.source_incremental_column, start, end)
    staged = project.stamp_audit_columns(scanned, {project.LOADED_AT: run_ts})
    if cfg.source_incremental_column:
        staged = filters.filter_late_rows(
            staged, cfg.source_incremental_column, final, cfg.target_incremental_column, late_policy
        )
    required = list(cfg.join_keys) + [c for c, _ in cfg.order_by if c != project.LOADED_AT]
    typed = project.project_typed(staged, source_types or {}, cfg.unix_seconds_columns)
    projected = project.project_snake_case(typed, required=required)
    if final is None:
        target = projected.filter(F.lit(False))
    else:
        target = schema.reconcile_schema(final, projected.schema)
        actual = {f.name: TY.warehouse_name(f.dataType) for f in target.schema.fields}
        desired = {f.name: TY.warehouse_name(f.dataType) for f in projected.schema.fields}
        projected = project.coerce_to_existing_type(projected, desired, actual).select(
            *[F.col(f.name).cast(f.dataType) for f in target.schema.fields]
        )
    latest = dedupe.dedupe_latest(projected, list(cfg.partition_by), list(cfg.order_by))
    return merge.merge_upsert(target, latest, list(cfg.join_keys), cfg.delete_not_matched_by_source)


def nps_history(
    spark,
    export_path: str,
    history: DataFrame | None,
    run_date: date,
    ingested_at: datetime,
    bloom_bits: int | None = None,
) -> DataFrame:
    """NDJSON export -> NPS rows -> raw (truncate load, declared schema) ->
    delete history rows with the same ``event_id`` and insert the latest raw
    row per id. Returns the new history."""
    objs = ndjson.scan_ndjson_export(spark, export_path)
    raw_rows = replace.truncate_load(records.nps_rows(objs, run_date, ingested_at), records.NPS_SCHEMA)
    # The raw table is written once (truncate load) and both halves of the
    # history refresh -- key delete and keep-latest insert -- read it.
    raw_path = scratch_path(spark, "nps-raw")
    raw_rows.write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    if history is None:
        history = raw.filter(F.lit(False))
    return replace.replace_by_key(history, raw, "event_id", records.NPS_ORDER, bloom_bits)


def nps_backfill(
    lines: DataFrame, history: DataFrame | None, start: date | str, end: date | str, partitions: int | None = None
) -> DataFrame:
    """Backfill of an inclusive day range as one job. Each event belongs to
    the day slice of its timestamp (``_run_date``), ingested at 06:00 the
    next morning; per ``event_id`` the latest day wins, as if the days had
    been replaced one after another. The bookmark is not touched."""
    start_d = date.fromisoformat(start) if isinstance(start, str) else start
    end_d = date.fromisoformat(end) if isinstance(end, str) else end
    if start_d > end_d:
        raise ValueError(f"backfill range is inverted: {start_d} > {end_d}")
    rows = records.nps_rows(
        lines, start_d, datetime.combine(start_d, datetime.min.time()), partitions=partitions, days=(start_d, end_d)
    )
    rows = (
        rows.withColumn("_run_date", F.to_date("event_timestamp"))
        .withColumn("_ingested_at", F.timestamp_add("HOUR", F.lit(30), F.col("_run_date").cast("timestamp_ntz")))
    )
    order = [("_run_date", "desc")] + records.NPS_ORDER
    latest = dedupe.dedupe_latest(rows.filter(F.col("event_id").isNotNull()), ["event_id"], order)
    if history is None:
        return latest
    return replace.delete_by_key(history, rows, "event_id").unionByName(latest)


def rows_per_day(df: DataFrame, ts_col: str, start: date | str, end: date | str) -> DataFrame:
    """Rows per calendar day of ``[start, end]``, days without rows as 0.
    The calendar has one row per day of the range; the counts are a
    partial-then-final aggregate of the data."""
    counts = df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    calendar = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("day")
    )
    return calendar.join(counts, "day", "left").select(
        "day", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n_rows")
    )


def predictions_batch(
    spark,
    batch_path: str,
    batch_id: str,
    loaded_at: datetime,
    raw: DataFrame | None,
    final: DataFrame | None,
    data_glob: str = "predictions_part_*.csv",
    bloom_bits: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One predictions batch: declared schema -> all data files into a
    staging table -> insert-only merge into raw on ``(batch_id, unique_id)``
    and into final on ``unique_id`` (``loaded_at`` becomes ``_ingested_at``).

    The staging table is written once to the shared folder and both merges
    read it, so a lost executor re-reads staged files instead of re-parsing
    the batch. Returns the new (raw, final)."""
    fields = csv_declared.read_schema_file(spark, f"{batch_path}/schema.csv")
    names = [f.name for f in fields]
    if "unique_id" not in names:
        raise ValueError("declared schema must contain unique_id")
    staged = csv_declared.read_declared_csv(spark, f"{batch_path}/{data_glob}", fields, batch_id, loaded_at)
    staging_path = scratch_path(spark, f"staging-{batch_id}")
    staged.write.parquet(staging_path)
    staging = spark.read.parquet(staging_path)
    raw_target = staging.filter(F.lit(False)) if raw is None else schema.evolve_schema_additive(raw, staging.schema)
    new_raw = merge.anti_insert(raw_target, staging, ["batch_id", "unique_id"], bloom_bits)
    final_rows = staging.select(*names, F.col("loaded_at").alias("_ingested_at"))
    final_target = final_rows.filter(F.lit(False)) if final is None else schema.evolve_schema_additive(final, final_rows.schema)
    new_final = merge.anti_insert(final_target, final_rows, ["unique_id"], bloom_bits)
    return new_raw, new_final


def ads_metadata(
    page_lines: DataFrame, stream: str, ingested_at: datetime, known: T.StructType | None = None, on_broken: str = "fail"
) -> DataFrame:
    """Metadata stream: pages -> rows with every field that arrived -> stamp
    -> truncate load."""
    rows = pages.flatten_paged_payload(page_lines, known, on_broken=on_broken)
    return replace.truncate_load(project.stamp_audit_columns(rows, {"_ingested_at": ingested_at, "_stream_name": stream}))


def ads_insights(
    page_lines: DataFrame,
    existing: DataFrame | None,
    start: date | str,
    end: date | str,
    stream: str,
    ingested_at: datetime,
    bookmarks: DataFrame | None,
    bookmark_field: str = "date_start",
    on_broken: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Insight stream for an inclusive day window: the pages of its days
    (column ``day``, pruned before anything is parsed) -> rows with every
    field that arrived, tagged with their day -> the table grown by new and
    widened columns -> its date range replaced (also when no rows came back)
    -> bookmark set to the window end. An inverted window (start after end)
    changes nothing, bookmark included. Without ``existing`` the table begins
    with this window."""
    spark = page_lines.sparkSession
    if bookmarks is None:
        bookmarks = spark.createDataFrame([], "stream string, field string, value date")
    if date.fromisoformat(str(start)) > date.fromisoformat(str(end)):
        return existing, bookmarks
    fetched = page_lines.filter(F.col("day").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
    rows = pages.land_rows(fetched.withColumnRenamed("day", "_window_date"), on_broken=on_broken).rows
    audit = ("_window_date", "_stream_name", "_ingested_at")
    known = T.StructType([f for f in existing.schema.fields if f.name not in audit]) if existing is not None else None
    schema_ = pages.inferred_schema(rows, known)
    if bookmark_field not in schema_.fieldNames():
        schema_ = schema_.add(bookmark_field, T.StringType())  # no row came back: nothing to date yet
    tagged = project.stamp_audit_columns(pages.typed_rows(rows, schema_), {"_stream_name": stream, "_ingested_at": ingested_at})
    table = tagged
    if existing is not None:
        table = replace.replace_date_range(pages.grow_table(existing, schema_), tagged, bookmark_field, start, end)
    return table, windows.advance_bookmark(bookmarks, stream, bookmark_field, end)


def ads_stream(
    cfg: AdsStream, page_lines: DataFrame, existing: DataFrame | None, start, end, ingested_at: datetime, bookmarks=None
) -> tuple[DataFrame, DataFrame | None]:
    """One run of a stream of the catalogue: its table, and the bookmarks."""
    if cfg.stream_type == "metadata":
        return ads_metadata(page_lines, cfg.stream_name, ingested_at), bookmarks
    return ads_insights(page_lines, existing, start, end, cfg.stream_name, ingested_at, bookmarks, cfg.bookmark_field)


def refresh_tracking_day_table(
    table_path: str,
    events: DataFrame,
    users: DataFrame,
    start: date | str,
    end: date | str,
    zone: str = TRACKING_ZONE,
) -> None:
    """The daily refresh against a table partitioned by local date: the
    rebuilt day is written with dynamic partition overwrite, so only that
    day's files are rewritten (an empty rebuild deletes the day)."""
    rebuilt = curate_tracking(events, users, start, end, zone)
    rebuilt = rebuilt.withColumn("local_date", TM.local_date_of(TM.millis_to_ntz(F.col("timestamp")), zone))
    days = []
    d = date.fromisoformat(str(start))
    while d < date.fromisoformat(str(end)):
        days.append(d.isoformat())
        d = date.fromordinal(d.toordinal() + 1)
    files.replace_partitions(rebuilt, table_path, ["local_date"], touched=days)


def usage_export(curated: DataFrame, today: date, zone: str, rows_per_part: int, out_dir: str, batch_id: str) -> str:
    """Weekly export of the curated tracking table: the week before the latest
    Tuesday -> exact parts in time order -> files of all 26 columns under their
    own names, with their manifest, whose path is returned."""
    start, end = windows.weekly_window(today)
    week = filters.filter_local_week(curated, "timestamp", start, end, zone)
    cut = chunk.chunk_rows_to_parts(week, [("timestamp", "asc")], rows_per_part)
    return parts.export_parts(cut, out_dir, list(project.TRACKING_LAYOUT), "timestamp", batch_id)


def nps_run(
    spark,
    export_path: str | None,
    history: DataFrame | None,
    bookmarks: DataFrame,
    run_date: date,
    ingested_at: datetime,
    lookback_days: int = windows.NPS_LOOKBACK_DAYS,
    explicit_start: date | None = None,
    explicit_end: date | None = None,
    full_refresh: bool = False,
    stream: str = "nps",
    field: str = "event_date",
) -> tuple[DataFrame, DataFrame]:
    """One scheduled NPS run: window from the bookmark -> export -> history
    refresh -> bookmark set to the window end. The export is not filtered by
    the window (the exporting service already cut it). An inverted window
    loads nothing (the raw table is emptied) and still sets the bookmark.
    Returns (history, bookmarks)."""
    current = bookmarks.filter((F.col("stream") == stream) & (F.col("field") == field)).agg(F.max("value"))
    mark = current.collect()[0][0]  # one scalar from the bookmark table
    w = windows.bookmark_window(run_date, mark, lookback_days, explicit_start, explicit_end, full_refresh)
    new_bookmarks = windows.advance_bookmark(bookmarks, stream, field, w.end)
    if w.inverted or export_path is None:
        if history is None:
            history = spark.createDataFrame([], records.NPS_SCHEMA)
        return history, new_bookmarks
    return nps_history(spark, export_path, history, run_date, ingested_at), new_bookmarks


def replicate_run(
    source: DataFrame,
    final: DataFrame | None,
    cfg: TableConfig,
    run_ts: datetime,
    now: datetime,
    explicit_start: datetime | None = None,
    explicit_end: datetime | None = None,
    previous_day: bool = False,
    fixed_minutes: int | None = None,
    lookback_seconds: int = windows.WATERMARK_LOOKBACK_SECONDS,
    late_policy: str = "drop",
) -> DataFrame:
    """One scheduled (daily / 30-minute) or backfill replication run.

    Snapshot tables read everything. Otherwise the window is the previous
    local day or the trailing minutes when scheduled that way and no bound is
    given; else the explicit bounds; else from the final table's watermark
    minus the lookback (a scalar subquery inside the plan). The late-row
    filter still applies, so a backfill cannot move rows behind the
    watermark unless ``late_policy="accept"``."""
    if cfg.is_snapshot:
        return replicate_table(source, final, cfg, run_ts)
    scheduled = explicit_start is None and explicit_end is None and (previous_day or fixed_minutes)
    if scheduled or explicit_start is not None or explicit_end is not None:
        w = windows.resolve_replication_window(
            now, None, explicit_start, explicit_end, previous_day, fixed_minutes, lookback_seconds=lookback_seconds
        )
        return replicate_table(source, final, cfg, run_ts, w.start, w.end, late_policy)
    if final is not None:
        source = scans.scan_above_watermark(
            source, cfg.source_incremental_column, final, cfg.target_incremental_column, lookback_seconds
        )
    return replicate_table(source, final, cfg, run_ts, late_policy=late_policy)
