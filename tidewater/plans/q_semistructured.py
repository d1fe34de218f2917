"""Queries of the NPS survey flow: NDJSON export scan, JSON rules, score
extraction, keep-latest per event, replace-by-key history and backfill."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import oracle as O
from tidewater.functions import semistructured as J
from tidewater.operators import dedupe, filters, records, replace
from tidewater.plans import jobs
from tidewater.plans.registry import register
from tidewater.session import scratch_path
from tidewater.sources import ndjson

RUN_DATE = date(2024, 1, 31)
INGESTED_AT = datetime(2024, 1, 31, 6, 0, 0)
RUN_SQL = "date '2024-01-31'"
INGESTED_SQL = "timestamp '2024-01-31 06:00:00'"

_WS = r"'^\s+|\s+$'"
_NUM = "'[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _stringify(j: str, path: str) -> str:
    return (
        f"case json_type({j},'{path}') when 'NULL' then 'None' "
        f"when 'BOOLEAN' then case when json_extract_string({j},'{path}')='true' then 'True' else 'False' end "
        f"when 'OBJECT' then json_extract({j},'{path}')::varchar when 'ARRAY' then json_extract({j},'{path}')::varchar "
        f"else nullif(json_extract_string({j},'{path}'),'') end"
    )


NPS_CTES = O.FX_NPS_FEED + f""",
nps_p as (select event_id as feed_id, line, json(line) j from fx_nps_feed where json_valid(line) and json_type(line) = 'OBJECT'),
nps_a as (select *, case when json_type(j,'$.attributes')='VARCHAR' and json_valid(json_extract_string(j,'$.attributes'))
   then json(json_extract_string(j,'$.attributes')) else json_extract(j,'$.attributes') end as attrs from nps_p),
nps_s as (select *, list_filter(coalesce(json_extract(attrs, '$.interactionData.surveyResponses[*]'), []),
   lambda r: coalesce(json_type(r)='OBJECT' and json_extract_string(r,'$.type')='nps_score'
     and json_type(r,'$.value') in ('BOOLEAN','BIGINT','UBIGINT','DOUBLE','VARCHAR'), false))[1] as resp from nps_a),
nps_v as (select *, case
   when resp is null then null
   when json_type(resp,'$.value')='BOOLEAN' then null
   when json_type(resp,'$.value')='VARCHAR' then
      case when regexp_full_match(regexp_replace(json_extract_string(resp,'$.value'), {_WS}, '', 'g'), {_NUM})
           then trunc(cast(regexp_replace(json_extract_string(resp,'$.value'), {_WS}, '', 'g') as double))::bigint end
   else trunc(json_extract_string(resp,'$.value')::double)::bigint end as nps_score from nps_s),
nps_rows as (select feed_id,
  {_stringify('j', '$.id')} as event_id,
  'appcues:v2:step_interaction' as event_name,
  timezone('UTC', cast(json_extract_string(j,'$.timestamp') as timestamptz)) as event_timestamp,
  {RUN_SQL} as _run_date,
  {_stringify('j', '$.user_id')} as user_id,
  {_stringify('j', '$.account_id')} as account_id,
  {_stringify('attrs', '$.experienceName')} as experience_name,
  {_stringify('attrs', '$.experienceType')} as experience_type,
  nps_score,
  attrs::varchar as attributes,
  case when json_type(j,'$.identity') is null or json_type(j,'$.identity')='NULL' then null
       else json_extract(j,'$.identity')::varchar end as identity,
  j::varchar as raw_payload,
  {INGESTED_SQL} as _ingested_at
 from nps_v
 where json_type(j,'$.name')='VARCHAR' and json_extract_string(j,'$.name') = 'appcues:v2:step_interaction'
  and json_type(attrs)='OBJECT'
  and (lower(coalesce(json_extract_string(attrs,'$.experienceType'),''))='nps'
       or upper(coalesce(json_extract_string(attrs,'$.experienceName'),'')) like '%NPS%')
  and nps_score is not null and coalesce(json_extract_string(j,'$.timestamp'),'') <> '')"""
_NPS_COLS = (
    "event_id, event_name, event_timestamp, _run_date, user_id, account_id, experience_name, "
    "experience_type, nps_score, attributes, identity, raw_payload, _ingested_at"
)
_NPS_TIEBREAK = (
    "event_timestamp desc nulls last, _ingested_at desc nulls last, event_name desc nulls last, "
    "_run_date desc nulls last, user_id desc nulls last, account_id desc nulls last, "
    "experience_name desc nulls last, experience_type desc nulls last, nps_score desc nulls last, "
    "attributes desc nulls last, identity desc nulls last, raw_payload desc nulls last"
)


def _nps(spark, sf, run_date=RUN_DATE, ingested_at=INGESTED_AT, cond=None):
    feed = fx.nps_feed(spark, sf)
    if cond is not None:
        feed = feed.filter(cond)
    # The feed comes from one file, which one task would parse.
    return records.nps_rows(feed, run_date, ingested_at, partitions=spark.sparkContext.defaultParallelism)


@register("filter_nps_event", "with " + NPS_CTES + f" select {_NPS_COLS} from nps_rows")
def q_filter_nps_event(spark, sf):
    """Event name, NPS experience, a score and a timestamp -> 13-column rows."""
    return _nps(spark, sf)


@register(
    "extract_nps_score",
    "with " + NPS_CTES + " select feed_id as event_key, nps_score from nps_v",
)
def q_extract_nps_score(spark, sf):
    """Score of every feed record (NULL where the rules give none)."""
    feed = fx.nps_feed(spark, sf)
    rec = J.parse_record("line")
    attrs = J.json_parse_or_keep(J.field(rec, "$.attributes"))
    return feed.selectExpr("event_id AS event_key", f"{J.extract_nps_score(attrs)} AS nps_score")


@register(
    "stringify_or_null",
    "with " + NPS_CTES + f" select feed_id as event_key, {_stringify('j', '$.id')} as event_id, "
    f"{_stringify('j', '$.account_id')} as account_id from nps_p",
)
def q_stringify_or_null(spark, sf):
    """``str(x) or None``: JSON null -> 'None', '' and missing -> NULL."""
    feed = fx.nps_feed(spark, sf)
    rec = J.parse_record("line")
    return feed.selectExpr(
        "event_id AS event_key",
        f"{J.stringify_or_null(J.field(rec, '$.id'))} AS event_id",
        f"{J.stringify_or_null(J.field(rec, '$.account_id'))} AS account_id",
    )


@register(
    "filter_key_not_null",
    "with " + NPS_CTES + f" select {_NPS_COLS} from nps_rows where event_id is not null",
)
def q_filter_key_not_null(spark, sf):
    return filters.filter_key_not_null(_nps(spark, sf), "event_id")


_LATEST_NPS = f" select {_NPS_COLS} from nps_rows where event_id is not null qualify row_number() over (partition by event_id order by {_NPS_TIEBREAK}) = 1"


@register("dedupe_latest_nps", "with " + NPS_CTES + _LATEST_NPS)
def q_dedupe_latest_nps(spark, sf):
    """Latest row per ``event_id``: ``event_timestamp DESC, _ingested_at DESC``."""
    return dedupe.dedupe_latest(
        filters.filter_key_not_null(_nps(spark, sf), "event_id"), ["event_id"], records.NPS_ORDER
    )


# History = an earlier run over two thirds of the feed; the new run covers two
# thirds as well, half of them the same events.
_REPLACE_SQL = (
    "with "
    + NPS_CTES
    + f""",
hist0 as (select {_NPS_COLS.replace('_run_date', "date '2024-01-20' as _run_date").replace('_ingested_at', "timestamp '2024-01-20 06:00:00' as _ingested_at")}
  from nps_rows where feed_id % 3 <> 0 and event_id is not null
  qualify row_number() over (partition by event_id order by {_NPS_TIEBREAK}) = 1),
raw as (select {_NPS_COLS} from nps_rows where feed_id % 3 <> 1)
select * from hist0 h where not exists (select 1 from raw r where r.event_id = h.event_id)
union all
select * from raw where event_id is not null
 qualify row_number() over (partition by event_id order by {_NPS_TIEBREAK}) = 1"""
)


def _stored(spark, df, name):
    """Land ``df`` as a table under the shared folder and read it back (the
    history and raw tables the refresh works on)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _history_and_raw(spark, sf):
    hist_rows = _nps(spark, sf, date(2024, 1, 20), datetime(2024, 1, 20, 6), F.col("event_id") % 3 != 0)
    hist = dedupe.dedupe_latest(filters.filter_key_not_null(hist_rows, "event_id"), ["event_id"], records.NPS_ORDER)
    raw = _nps(spark, sf, cond=F.col("event_id") % 3 != 1)
    return _stored(spark, hist, "nps-history"), _stored(spark, raw, "nps-raw")


@register("replace_by_key", _REPLACE_SQL)
def q_replace_by_key(spark, sf):
    """Delete history rows whose key is in the new raw rows, insert the
    latest raw row per key."""
    hist, raw = _history_and_raw(spark, sf)
    return replace.replace_by_key(hist, raw, "event_id", records.NPS_ORDER)


@register(
    "semi_delete_nps_history",
    _REPLACE_SQL.split("\nunion all\n")[0],
)
def q_semi_delete_nps_history(spark, sf):
    """The delete half of the history refresh on its own."""
    hist, raw = _history_and_raw(spark, sf)
    return replace.delete_by_key(hist, raw, "event_id")


def land_feed(spark, sf, with_junk: bool = True, compression: str = "gzip") -> str:
    """Write the NPS feed as an NDJSON export (gzip text files) to a fresh
    folder under the shared checkpoint folder; blank, malformed and
    non-object lines are mixed in the way real exports carry them."""
    feed = fx.nps_feed(spark, sf).select("event_id", "line")
    lines = feed
    if with_junk:
        ev = F.col("event_id")
        junk = (
            feed.filter((ev % 89 == 0) | (ev % 97 == 0) | (ev % 83 == 0))
            .select(
                "event_id",
                F.when(ev % 89 == 0, F.lit('{"id": "broken'))
                .when(ev % 97 == 0, F.lit("   "))
                .otherwise(F.lit("[1,2,3]"))
                .alias("line"),
            )
        )
        lines = feed.unionByName(junk)
    path = scratch_path(spark, "nps-export")
    # The export arrives split into parts (one gzip file per part).
    parts = spark.sparkContext.defaultParallelism
    lines.select("line").repartition(parts).write.option("compression", compression).text(path)
    return path


@register(
    "scan_ndjson_export",
    "with " + O.FX_NPS_FEED + " select line, json_extract_string(line, '$.name') as name from fx_nps_feed",
)
def q_scan_ndjson_export(spark, sf):
    """Read a gzip NDJSON export: blank, malformed and non-object lines are
    skipped; each kept line carries its parsed record."""
    path = land_feed(spark, sf)
    objs = ndjson.scan_ndjson_export(spark, path)
    return objs.select("line", F.try_variant_get("record", "$.name", "string").alias("name"))


@register("job_nps_history", "with " + NPS_CTES + _LATEST_NPS)
def q_job_nps_history(spark, sf):
    """Export landed as NDJSON -> records -> NPS rows -> raw (truncate load) ->
    replace_by_key into an empty history."""
    path = land_feed(spark, sf)
    return jobs.nps_history(spark, path, None, RUN_DATE, INGESTED_AT)


# --- backfill: one job over the whole day range ----------------------------------

BF_START, BF_END = "2024-01-05", "2024-01-12"
_BF_SQL = (
    "with "
    + NPS_CTES
    + f""",
bf as (select {_NPS_COLS.replace('_run_date,', 'cast(event_timestamp as date) as _run_date,').replace('_ingested_at', "cast(cast(event_timestamp as date) + interval 1 day + interval 6 hour as timestamp) as _ingested_at")}
  from nps_rows where cast(event_timestamp as date) between date '{BF_START}' and date '{BF_END}')
select * from bf where event_id is not null
 qualify row_number() over (partition by event_id order by _run_date desc, {_NPS_TIEBREAK}) = 1"""
)


@register("backfill_by_day", _BF_SQL)
def q_backfill_by_day(spark, sf):
    """Each day of an inclusive range re-exported and replaced by key, as one
    job: later days overwrite earlier ones."""
    return jobs.nps_backfill(fx.nps_feed(spark, sf), None, BF_START, BF_END, spark.sparkContext.defaultParallelism)


@register(
    "agg_backfill_by_day",
    "with "
    + NPS_CTES
    + f""",
days as (select cast(d as date) as day from generate_series(date '{BF_START}', date '2024-01-14', interval 1 day) t(d))
select days.day, count(n.feed_id)::bigint as n_rows from days
 left join nps_rows n on cast(n.event_timestamp as date) = days.day group by days.day""",
)
def q_agg_backfill_by_day(spark, sf):
    """Rows per day of the range, zero-filled from a calendar."""
    rows = _nps(spark, sf)
    return jobs.rows_per_day(rows, "event_timestamp", BF_START, "2024-01-14")


@register(
    "json_parse_or_keep",
    """select event_id, case when json_valid(v) then json_type(v) else 'STRING' end as kind,
 case when json_valid(v) then json(v)::varchar else v end as text
 from (select event_id, case when event_id % 3 = 0 then event_type else props end as v from events)""",
)
def q_json_parse_or_keep(spark, sf):
    """Text that is valid JSON becomes that value, other text stays text."""
    ev = fx.table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 3 = 0 THEN event_type ELSE props END AS v"
    )
    val = J.json_parse_or_keep_text("v")
    return ev.selectExpr("event_id", f"{J.variant_kind(val)} AS kind", f"{J.json_compact_text(val)} AS text")


@register(
    "json_compact_text",
    "with " + O.FX_NPS_FEED + " select event_id, json_extract(line, '$.attributes.interactionData')::varchar as text from fx_nps_feed",
)
def q_json_compact_text(spark, sf):
    """Objects and arrays to compact JSON text."""
    feed = fx.nps_feed(spark, sf)
    rec = J.parse_record("line")
    return feed.selectExpr("event_id", f"{J.json_compact_text(J.field(rec, '$.attributes.interactionData'))} AS text")


@register("truncate_load", "with " + NPS_CTES + f" select {_NPS_COLS} from nps_rows")
def q_truncate_load(spark, sf):
    """Raw table contents replaced by this run's rows, in the declared schema."""
    return replace.truncate_load(_nps(spark, sf), records.NPS_SCHEMA)
