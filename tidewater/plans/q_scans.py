"""Queries of file-landed sources: declared-schema CSV batches (weekly
predictions), paged JSON payloads and day-sliced insights (ads), and
inferred-schema JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fixtures as fx
from tidewater.operators import project, replace
from tidewater.plans import configs as CFG
from tidewater.plans import jobs
from tidewater.plans.registry import register
from tidewater.session import scratch_path
from tidewater.sinks import files
from tidewater.sources import csv_declared as CSV
from tidewater.sources import pages, scans

INGESTED = datetime(2024, 2, 1, 6)
B1_LOADED, B2_LOADED = datetime(2024, 1, 3, 17), datetime(2024, 1, 10, 17)

# schema.csv of the synthesised predictions batch: header synonyms, an
# unknown type, a declared column the data files lack.
SCHEMA_CSV_ROWS = [
    ("unique_id", "INTEGER", "REQUIRED", "customer key"),
    ("customer_name", "STRING", "NULLABLE", ""),
    ("segment", "ENUM", "NULLABLE", ""),
    ("score", "NUMERIC", "NULLABLE", "account balance"),
    ("scored_at", "TIMESTAMP", "yes", ""),
    ("is_active", "BOOLEAN", "", ""),
    ("notes", "WEIRDTYPE", "", ""),
]

_PRED_SQL = """
pred as (select c_custkey as unique_id,
  case when c_custkey % 11 = 0 then c_name || chr(10) || '"' || c_mktsegment || '", ' else c_name end as customer_name, c_mktsegment as segment,
  cast(c_acctbal as decimal(38,9)) as score,
  make_timestamp(2024, 1, 1 + cast(c_custkey % 7 as int), cast(c_custkey % 24 as int), cast(c_custkey % 60 as int), 0.0) as scored_at,
  c_acctbal > 0 as is_active, '' as notes from customer)"""


def _pred_rows(spark, sf, cond):
    c = fx.table(spark, sf, "customer").filter(cond)
    key = F.col("c_custkey")
    ts_text = F.format_string(
        "2024-01-%02d%s%02d:%02d:00",
        (key % 7 + 1).cast("int"),
        F.when(key % 2 == 0, F.lit("T")).otherwise(F.lit(" ")),
        (key % 24).cast("int"),
        (key % 60).cast("int"),
    )
    return c.select(
        key.cast("string").alias("unique_id"),
        F.when(key % 11 == 0, F.format_string('%s\n"%s", ', "c_name", "c_mktsegment")).otherwise(F.col("c_name")).alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.format_string("%.2f", F.col("c_acctbal")).alias("score"),
        ts_text.alias("scored_at"),
        F.when(F.col("c_acctbal") > 0, F.lit("true")).otherwise(F.lit("false")).alias("is_active"),
        F.lit("x").alias("unexpected_extra_column"),
    )


def land_batch(spark, sf, root: str, batch: str, cond, parts: int = 3) -> str:
    """Write one predictions batch folder: ``predictions_part_*.csv`` data
    files, ``schema.csv`` and ``metadata.json``."""
    path = f"{root}/{batch}"
    tmp = scratch_path(spark, f"pred-{batch}")
    rows = _pred_rows(spark, sf, cond)
    rows.repartition(parts).write.options(**files.CSV_DIALECT).csv(tmp)
    # Give data files the names the batch contract expects.
    fs, src = files._fs(spark, tmp)
    fs.mkdirs(files._fs(spark, path)[1])
    n = 0
    for st in fs.listStatus(src):
        name = st.getPath().getName()
        if name.startswith("part-") and name.endswith(".csv"):
            n += 1
            fs.rename(st.getPath(), files._fs(spark, f"{path}/predictions_part_{n:03d}.csv")[1])
    schema_csv = "field_name,data_type,mode,description\n" + "".join(",".join(r) + "\n" for r in SCHEMA_CSV_ROWS)
    files.write_text_file(spark, f"{path}/schema.csv", schema_csv)
    files.write_text_file(spark, f"{path}/metadata.json", '{"batch_id": "%s", "files": %d}' % (batch, n))
    return path


def _landed_two_batches(spark, sf):
    root = scratch_path(spark, "predictions-landing")
    land_batch(spark, sf, root, "b1", F.col("c_custkey") % 3 != 0)
    land_batch(spark, sf, root, "b2", F.col("c_custkey") % 3 != 1)
    return root


@register("scan_csv_declared_schema", "with " + _PRED_SQL + " select * from pred")
def q_scan_csv_declared_schema(spark, sf):
    """Data files projected onto schema.csv: types from the declared map,
    ``T`` and space timestamps, unknown column ignored, declared-but-absent
    string column empty."""
    root = scratch_path(spark, "predictions-landing")
    path = land_batch(spark, sf, root, "b1", F.lit(True))
    fields = CSV.read_schema_file(spark, f"{path}/schema.csv")
    return CSV.read_declared_csv(spark, f"{path}/predictions_part_*.csv", fields)


@register("scan_latest_batch", "with " + _PRED_SQL + " select * from pred where unique_id % 3 <> 1")
def q_scan_latest_batch(spark, sf):
    """Newest complete batch folder (by file time, then name) read alone."""
    root = _landed_two_batches(spark, sf)
    path = CSV.latest_batch(spark, root)
    fields = CSV.read_schema_file(spark, f"{path}/schema.csv")
    return CSV.read_declared_csv(spark, f"{path}/predictions_part_*.csv", fields)


@register(
    "union_file_parts",
    "with " + _PRED_SQL + " select * from pred",
)
def q_union_file_parts(spark, sf):
    """Several part files of one batch loaded as one staging table (one scan
    over the list of paths)."""
    root = scratch_path(spark, "predictions-landing")
    path = land_batch(spark, sf, root, "b1", F.lit(True), parts=4)
    fields = CSV.read_schema_file(spark, f"{path}/schema.csv")
    files = [f"{path}/predictions_part_{i:03d}.csv" for i in range(1, 5)]
    return CSV.read_declared_csv(spark, files, fields)


@register(
    "normalize_csv_timestamp",
    """select o_orderkey, s, coalesce(try_strptime(s, '%Y-%m-%dT%H:%M:%S'), try_strptime(s, '%Y-%m-%d %H:%M:%S')) as parsed
 from (select o_orderkey, case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
   when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') else '' end as s from orders)""",
)
def q_normalize_csv_timestamp(spark, sf):
    """Two accepted layouts; empty text -> NULL (anything else would fail)."""
    o = fx.table(spark, sf, "orders")
    s = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit(""))
    )
    df = o.select("o_orderkey", s.alias("s"))
    return df.withColumn("parsed", CSV.normalize_csv_timestamp(F.col("s")))


_STAGE_FINAL_SQL = (
    "with "
    + _PRED_SQL
    + """,
b1 as (select * from pred where unique_id % 3 <> 0), b2 as (select * from pred where unique_id % 3 <> 1)
select *, timestamp '2024-01-03 17:00:00' as _ingested_at from b1
union all select *, timestamp '2024-01-10 17:00:00' as _ingested_at from b2 where unique_id % 3 = 0"""
)


@register("stage_then_merge", _STAGE_FINAL_SQL)
def q_stage_then_merge(spark, sf):
    """Batch b1 then b2 through staging: each staging frame feeds the raw
    merge on (batch_id, unique_id) and the final merge on unique_id; returns
    the final table (first write wins)."""
    root = _landed_two_batches(spark, sf)
    raw = final = None
    for batch, loaded in (("b1", B1_LOADED), ("b2", B2_LOADED)):
        raw, final = jobs.predictions_batch(spark, f"{root}/{batch}", batch, loaded, raw, final)
    return final


@register("job_predictions", _STAGE_FINAL_SQL)
def q_job_predictions(spark, sf):
    """Weekly predictions: b1 already loaded; pick the latest batch (b2),
    read it with its declared schema, stage, merge insert-only into raw and
    final."""
    root = _landed_two_batches(spark, sf)
    raw, final = jobs.predictions_batch(spark, f"{root}/b1", "b1", B1_LOADED, None, None)
    latest = CSV.latest_batch(spark, root)
    batch_id = latest.rstrip("/").split("/")[-1]
    raw, final = jobs.predictions_batch(spark, latest, batch_id, B2_LOADED, raw, final)
    return final


# --- ads: paged payloads, day slices, date-range replace --------------------------

RANGE_START, RANGE_END = "1998-12-01", "1999-01-31"
_INSIGHT_SQL = """
ins as (select l_orderkey as ad_id, l_linenumber::bigint as line, strftime(l_shipdate, '%Y-%m-%d') as date_start,
  l_quantity as impressions, l_extendedprice as spend,
  case when l_linenumber = 3 then '[{"action_type":"link_click","value":"' || l_partkey || '"}]' end as actions,
  case when l_linenumber = 7 then l_suppkey end as clicks from lineitem)"""
# Columns whose types a table has settled already; the others are found.
INSIGHT_KNOWN = (
    T.StructType()
    .add("ad_id", T.LongType())
    .add("line", T.LongType())
    .add("date_start", T.StringType())
    .add("impressions", T.DoubleType())
    .add("spend", T.DoubleType())
)


def insight_rows(spark, sf):
    """Insight rows as JSON text: ids and amounts as numbers or as text, two
    fields that only some rows have, one of them nested."""
    text = """concat('{"ad_id":', if(l_linenumber % 2 = 0, concat('"', l_orderkey, '"'), string(l_orderkey)), ',"line":', l_linenumber,
      ',"date_start":"', string(to_date(l_shipdate)), '","impressions":', l_quantity, ',"spend":"', l_extendedprice, '"',
      if(l_linenumber = 3, concat(',"actions":[{"action_type":"link_click","value":"', l_partkey, '"}]'), ''),
      if(l_linenumber = 7, concat(',"clicks":', l_suppkey), ''), '}') as json"""
    return fx.table(spark, sf, "lineitem").selectExpr("l_orderkey as ad_id", "to_date(l_shipdate) as day", text)


def insight_pages(spark, sf):
    """API response pages derived from the insight rows: ``{"data": [...],
    "paging": {"next": ...}}``, one page per 100 ad ids (bounded size). Every
    seventh page was also received cut short, and one response is an error."""
    whole = pages.pages_from_rows(insight_rows(spark, sf), F.floor(F.col("ad_id") / 100), "json")
    after = F.regexp_extract("page", r'"after":"([0-9]+)"', 1).cast("bigint")
    cut = whole.filter(after % 7 == 3).select(F.expr("substring(page, 1, length(page) - 9)").alias("page"))
    error = spark.range(1).select(F.lit('{"error":{"code":17,"message":"request limit reached"}}').alias("page"))
    return whole.union(cut).union(error)


def insight_pages_by_day(spark, sf):
    """The same rows as fetched day by day: about 100 rows per page."""
    rows = insight_rows(spark, sf)
    per_day = max(1, fx.table(spark, sf, "lineitem").count() // 250_000)  # row count of the files' footers
    return pages.pages_from_rows(rows, F.pmod(F.xxhash64("ad_id"), F.lit(per_day)), "json", ["day"])


@register("flatten_paged_payload", "with " + _INSIGHT_SQL + " select * from ins")
def q_flatten_paged_payload(spark, sf):
    """Every page's ``data`` array concatenated into typed rows: numbers sent
    as text keep their value, fields that are not known become columns, and
    pages that can't be read are set aside."""
    path = pages.land_pages(insight_pages(spark, sf), scratch_path(spark, "ads-pages"))
    return pages.flatten_paged_payload(spark.read.text(path), INSIGHT_KNOWN, on_broken="quarantine")


@register(
    "flatten_paged_quarantine",
    """select 'not JSON' as reason, count(distinct l_orderkey // 100)::bigint as n_pages from lineitem where (l_orderkey // 100) % 7 = 3
 union all select 'error response', 1""",
)
def q_flatten_paged_quarantine(spark, sf):
    """Pages that can't be read, by reason."""
    path = pages.land_pages(insight_pages(spark, sf), scratch_path(spark, "ads-pages"))
    broken = pages.land_rows(spark.read.text(path), on_broken="quarantine").broken
    return broken.groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("n_pages"))


@register(
    "infer_json_schema",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, "
    "o_orderpriority from orders",
)
def q_infer_json_schema(spark, sf):
    """Rows loaded from JSON with an inferred schema (integers -> BIGINT,
    decimals -> DOUBLE, text -> STRING)."""
    o = fx.table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = scratch_path(spark, "orders-json")
    o.select(F.to_json(F.struct(*o.columns)).alias("value")).write.text(path)
    return pages.infer_json(spark, path)


_DAY_SQL = f"""select *, cast(ts as date) as _window_date from events
 where ts >= timestamp '2024-01-18' and ts < timestamp '2024-01-25'"""


@register("scan_day_slices", _DAY_SQL)
def q_scan_day_slices(spark, sf):
    """Days 2024-01-18..24 inclusive, each row tagged with its day: one scan."""
    return scans.scan_day_slices(fx.table(spark, sf, "events"), "ts", "2024-01-18", "2024-01-24")


@register("union_day_slices", _DAY_SQL)
def q_union_day_slices(spark, sf):
    """Per-day results concatenated before one load (landed day-partitioned,
    read back with partition pruning)."""
    ev = fx.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    root = scratch_path(spark, "events-by-day")
    ev.write.partitionBy("day").parquet(root)
    days = scans.read_day_partitions(spark, root, "2024-01-18", "2024-01-24")
    return days.withColumnRenamed("day", "_window_date")


@register(
    "replace_date_range",
    """select * from events where ts < timestamp '2024-01-21'
   and not (cast(ts as date) between date '2024-01-18' and date '2024-01-24')
 union all select * from events where cast(ts as date) between date '2024-01-18' and date '2024-01-24'""",
)
def q_replace_date_range(spark, sf):
    """Target up to 2024-01-20; delete days 18..24 (inclusive), append the
    new rows of those days: 5,649 kept + 2,345 new at sf0.01."""
    ev = fx.table(spark, sf, "events")
    target = ev.filter(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    new = scans.scan_day_slices(ev, "ts", "2024-01-18", "2024-01-24").drop("_window_date")
    return replace.replace_date_range(target, new, "ts", "2024-01-18", "2024-01-24")


@register(
    "append_evolving",
    """select event_id, ts, user_id, event_type, value, cast(null as varchar) as props from events where ts < timestamp '2024-01-15'
 union all select event_id, ts, user_id, event_type, value, props from events where ts >= timestamp '2024-01-15'""",
)
def q_append_evolving(spark, sf):
    """Append a batch that brings a new column; older rows read NULL."""
    ev = fx.table(spark, sf, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    old = ev.filter(F.col("ts") < cut).drop("props")
    return replace.append_evolving(old, ev.filter(F.col("ts") >= cut))


_META_SQL = """
meta as (select p_partkey as id, p_name as name, p_brand as brand,
  timestamp '2024-02-01 06:00:00' as _ingested_at, 'ads' as _stream_name from part)"""


def ad_metadata_pages(spark, sf):
    p = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")
    )
    return pages.pages_from_rows(p, F.floor(F.col("id") / 100))


@register("job_ads_metadata", "with " + _META_SQL + " select * from meta")
def q_job_ads_metadata(spark, sf):
    """Pages -> flatten -> stamp ``_ingested_at``/``_stream_name`` -> truncate
    load (the stream's primary key is not used)."""
    path = pages.land_pages(ad_metadata_pages(spark, sf), scratch_path(spark, "ads-meta"))
    return jobs.ads_metadata(spark.read.text(path), "ads", INGESTED)


@register(
    "agg_rows_by_stream",
    "with " + _META_SQL + "," + _INSIGHT_SQL + """
select 'ads' as _stream_name, count(*)::bigint as n_rows from meta
union all select 'ads_insights' as _stream_name, count(*)::bigint from ins""",
)
def q_agg_rows_by_stream(spark, sf):
    """Rows loaded per stream."""

    def landed(lines, stream):
        rows = pages.land_rows(lines.withColumnRenamed("page", "value"), on_broken="quarantine").rows
        return rows.select(F.lit(stream).alias("_stream_name"))

    both = landed(ad_metadata_pages(spark, sf), "ads").unionByName(landed(insight_pages(spark, sf), "ads_insights"))
    return both.groupBy("_stream_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@register(
    "job_ads_insights",
    "with "
    + _INSIGHT_SQL
    + f""",
tagged as (select *, cast(date_start as date) as _window_date, 'ads_insights' as _stream_name,
   timestamp '2024-02-01 06:00:00' as _ingested_at from ins)
select * replace (null::varchar as actions, null::bigint as clicks) from tagged where date_start <= '1998-12-31'
  and not (cast(date_start as date) between date '{RANGE_START}' and date '{RANGE_END}')
union all select * from tagged where cast(date_start as date) between date '{RANGE_START}' and date '{RANGE_END}'""",
)
def q_job_ads_insights(spark, sf):
    """Daily insights for the window: the pages of its days -> flatten -> day
    tag -> grow the table, which has no ``actions`` and ``clicks`` yet, and
    replace the inclusive date range in it -> advance the bookmark."""
    li = fx.table(spark, sf, "lineitem").filter("l_shipdate < timestamp_ntz '1999-01-01'")
    existing = li.selectExpr(
        "l_orderkey as ad_id", "bigint(l_linenumber) as line", "date_format(l_shipdate, 'yyyy-MM-dd') as date_start",
        "l_quantity as impressions", "l_extendedprice as spend", "to_date(l_shipdate) as _window_date",
    )
    existing = project.stamp_audit_columns(existing, {"_stream_name": "ads_insights", "_ingested_at": INGESTED})
    path = pages.land_pages(insight_pages_by_day(spark, sf), scratch_path(spark, "ads-insights"))
    table, _bookmarks = jobs.ads_insights(
        spark.read.parquet(path), existing, RANGE_START, RANGE_END, "ads_insights", INGESTED, None
    )
    return table


# --- ads: the whole catalogue --------------------------------------------------------

CATALOGUE_START, CATALOGUE_END = "2024-01-10", "2024-01-20"
# The table that stands for each metadata stream, and its columns.
_METADATA_OF = {
    "adcreative": ("part", {"id": "p_partkey", "name": "p_name", "object_type": "p_type"}),
    "ads": ("customer", {"id": "c_custkey", "name": "c_name", "bid_amount": "c_acctbal"}),
    "adsets": ("supplier", {"id": "s_suppkey", "name": "s_name", "daily_budget": "s_acctbal"}),
    "campaigns": ("nation", {"id": "n_nationkey", "name": "n_name", "objective": "n_regionkey"}),
}


def _catalogue_sql() -> str:
    of = []
    for s in CFG.ADS_STREAMS:
        if s.stream_type == "metadata":
            name, cols = _METADATA_OF[s.stream_name]
            of.append(f"select '{s.stream_name}' as stream, count(*)::bigint as n_rows, {len(cols) + 2}::bigint as n_columns, sum({cols['id']})::bigint as amount from {name}")
        else:
            of.append(
                f"select '{s.stream_name}', count(*)::bigint, {5 + len(s.breakdowns) + 2}::bigint, sum(user_id)::bigint "
                f"from events where cast(ts as date) between date '{CATALOGUE_START}' and date '{CATALOGUE_END}'"
            )
    return " union all ".join(of)


def catalogue_pages(spark, sf, stream):
    """Pages of one stream of the catalogue, ids and amounts sent as text."""
    if stream.stream_type == "metadata":
        name, cols = _METADATA_OF[stream.stream_name]
        rows = fx.table(spark, sf, name).select(*[F.col(c).cast("string").alias(n) for n, c in cols.items()])
        return pages.pages_from_rows(rows, F.floor(F.col("id").cast("bigint") / 100))
    rows = fx.table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), F.col("user_id").cast("string").alias("ad_id"), F.to_date("ts").cast("string").alias("date_start"),
        F.col("event_id").alias("clicks"), F.col("value").cast("string").alias("spend"),
        *[F.col("event_type").alias(b) for b in stream.breakdowns],
    )
    json = F.to_json(F.struct(*[c for c in rows.columns if c != "day"]))
    return pages.pages_from_rows(rows.withColumn("json", json), F.floor(F.col("clicks") / 1000), "json", ["day"])


@register("job_ads_catalogue", _catalogue_sql())
def q_job_ads_catalogue(spark, sf):
    """Every stream of the catalogue from its config: pages -> table; per
    stream its rows, columns and the sum of its ids, which came as text."""
    tables = []
    for cfg in CFG.ADS_STREAMS:
        path = pages.land_pages(catalogue_pages(spark, sf, cfg), scratch_path(spark, f"ads-{cfg.stream_name}"))
        lines = spark.read.text(path) if cfg.stream_type == "metadata" else spark.read.parquet(path)
        loaded, _ = jobs.ads_stream(cfg, lines, None, CATALOGUE_START, CATALOGUE_END, INGESTED)
        key = "id" if cfg.stream_type == "metadata" else "ad_id"
        tables.append(
            loaded.agg(
                F.lit(cfg.stream_name).alias("stream"),
                F.count(F.lit(1)).alias("n_rows"),
                F.lit(len(loaded.columns)).cast("bigint").alias("n_columns"),
                F.sum(F.col(key).cast("bigint")).alias("amount"),
            )
        )
    return replace.union_all(tables)
