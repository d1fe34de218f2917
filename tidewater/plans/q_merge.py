"""Queries of relational replication: scans, watermark, late rows, keep-latest,
MERGE classification and results, insert-only merges, key deletes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import oracle as O
from tidewater.functions import time as TM
from tidewater.operators import dedupe, filters, joins, keys, merge, project, replace, schema
from tidewater.plans import jobs
from tidewater.plans.configs import CONFIGS_BY_NAME
from tidewater.plans.registry import register
from tidewater.sources import scans

RUN_TS = datetime(2024, 2, 1, 5, 0, 0)
RUN_TS_SQL = "timestamp '2024-02-01 05:00:00'"
WIN_START, WIN_END = datetime(1998, 1, 1), datetime(1998, 12, 31)

_OF = O.with_ctes(O.FX_ORDERS_FINAL)
_OFR = O.with_ctes(O.FX_ORDERS_FINAL, O.FX_ORDERS_RAW)
_WM_SQL = "(select coalesce(max(updated_at), timestamp '1970-01-01') from fx_orders_final)"
_SNAKE_SQL = 'select id, "orderNo" as order_no, status, total, "updatedAt" as updated_at'
_LATEST_SQL = f"""
 latest as (select * from ({_SNAKE_SQL} from fx_orders_raw where "updatedAt" > {_WM_SQL}) s
   qualify row_number() over (partition by id order by updated_at desc nulls last,
     order_no desc nulls last, status desc nulls last, total desc nulls last) = 1)"""
_ORDER_BY = [("updated_at", "desc")]


def _orders(spark, sf):
    return fx.table(spark, sf, "orders")


@register(
    "scan_incremental_window",
    "select * from orders where o_orderdate > timestamp '1998-01-01' and o_orderdate <= timestamp '1998-12-31'",
)
def q_scan_incremental_window(spark, sf):
    """``inc > start AND inc <= end``, both bounds pushed to the scan."""
    return scans.scan_incremental_window(_orders(spark, sf), "o_orderdate", WIN_START, WIN_END)


@register("scan_full_snapshot", "select * from orders")
def q_scan_full_snapshot(spark, sf):
    return scans.scan_full_snapshot(_orders(spark, sf))


@register(
    "scan_above_watermark",
    _OF + "select * from orders where o_orderdate > (select max(updated_at) from fx_orders_final) - interval 2 day",
)
def q_scan_above_watermark(spark, sf):
    """From ``MAX(final.updated_at) - 2 days`` onwards (lookback in seconds)."""
    return scans.scan_above_watermark(
        _orders(spark, sf), "o_orderdate", fx.orders_final(spark, sf), "updated_at", lookback_seconds=2 * 86400
    )


@register(
    "order_by_incremental",
    "select * from orders where o_orderdate > timestamp '1998-01-01' and o_orderdate <= timestamp '1998-12-31' "
    "order by o_orderdate, o_orderkey",
)
def q_order_by_incremental(spark, sf):
    """Extraction order by the incremental column (kept only as a query;
    jobs omit it since order is lost on load)."""
    return scans.scan_incremental_window(_orders(spark, sf), "o_orderdate", WIN_START, WIN_END).orderBy(
        "o_orderdate", "o_orderkey"
    )


@register("agg_max_watermark", _OF + "select max(updated_at) as watermark from fx_orders_final")
def q_agg_max_watermark(spark, sf):
    return fx.orders_final(spark, sf).agg(F.max("updated_at").alias("watermark"))


@register("filter_late_rows", _OFR + f'select * from fx_orders_raw where "updatedAt" > {_WM_SQL}')
def q_filter_late_rows(spark, sf):
    """Staged rows strictly above the final table's max; ties drop."""
    return filters.filter_late_rows(fx.orders_raw(spark, sf), "updatedAt", fx.orders_final(spark, sf), "updated_at")


@register(
    "late_row_policy",
    _OF + "select * from orders where o_orderdate > timestamp '1999-06-01' and o_orderdate <= timestamp '2000-03-01' "
    f"and o_orderdate > {_WM_SQL}",
)
def q_late_row_policy(spark, sf):
    """A backfill window reaching below the watermark: older rows are dropped."""
    win = scans.scan_incremental_window(_orders(spark, sf), "o_orderdate", datetime(1999, 6, 1), datetime(2000, 3, 1))
    return filters.filter_late_rows(win, "o_orderdate", fx.orders_final(spark, sf), "updated_at")


@register(
    "project_snake_case",
    O.with_ctes(O.FX_ORDERS_RAW) + f"{_SNAKE_SQL} from fx_orders_raw",
)
def q_project_snake_case(spark, sf):
    return project.project_snake_case(fx.orders_raw(spark, sf), required=["id", "updated_at"])


@register(
    "dedupe_latest",
    "select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber "
    "order by l_shipdate desc nulls last, l_extendedprice desc nulls last, l_partkey desc nulls last, "
    "l_suppkey desc nulls last) = 1",
)
def q_dedupe_latest(spark, sf):
    """Latest row per ``(l_orderkey, l_linenumber)``."""
    li = fx.table(spark, sf, "lineitem")
    return dedupe.dedupe_latest(
        li,
        ["l_orderkey", "l_linenumber"],
        [("l_shipdate", "desc"), ("l_extendedprice", "desc"), ("l_partkey", "desc"), ("l_suppkey", "desc")],
    )


def _latest_source(spark, sf):
    staged = filters.filter_late_rows(fx.orders_raw(spark, sf), "updatedAt", fx.orders_final(spark, sf), "updated_at")
    return dedupe.dedupe_latest(project.project_snake_case(staged), ["id"], _ORDER_BY)


_MATCH_SQL = _OFR + "," + _LATEST_SQL + """
select coalesce(t.id, s.id) as id,
 case when t.id is not null and s.id is not null then 'matched' when s.id is not null then 'not_matched'
      else 'not_matched_by_source' end as action
from fx_orders_final t full outer join latest s on t.id = s.id"""


@register("merge_match", _MATCH_SQL)
def q_merge_match(spark, sf):
    """Per key: matched / not matched / not matched by source."""
    return merge.merge_match(fx.orders_final(spark, sf), _latest_source(spark, sf), ["id"])


@register(
    "agg_merge_counts",
    f"select action, count(*)::bigint as n_rows from ({_MATCH_SQL}) m group by action",
)
def q_agg_merge_counts(spark, sf):
    return merge.merge_counts(merge.merge_match(fx.orders_final(spark, sf), _latest_source(spark, sf), ["id"]))


_UPSERT_SQL = _OFR + "," + _LATEST_SQL + """
select coalesce(s.id, t.id) as id,
 case when s.id is not null then s.order_no else t.order_no end as order_no,
 case when s.id is not null then s.status else t.status end as status,
 case when s.id is not null then s.total else t.total end as total,
 case when s.id is not null then s.updated_at else t.updated_at end as updated_at
from fx_orders_final t full outer join latest s on t.id = s.id"""


@register("merge_upsert_latest", _UPSERT_SQL)
def q_merge_upsert_latest(spark, sf):
    """Project -> late filter -> keep-latest -> MERGE (update + insert)."""
    return merge.merge_upsert(fx.orders_final(spark, sf), _latest_source(spark, sf), ["id"])


@register(
    "merge_full_sync",
    O.with_ctes(O.FX_ORDERS_RAW)
    + f"""select * from ({_SNAKE_SQL} from fx_orders_raw) s
   qualify row_number() over (partition by id order by updated_at desc nulls last,
     order_no desc nulls last, status desc nulls last, total desc nulls last) = 1""",
)
def q_merge_full_sync(spark, sf):
    """MERGE with ``WHEN NOT MATCHED BY SOURCE THEN DELETE`` (no late filter):
    the final table becomes the deduplicated source."""
    src = dedupe.dedupe_latest(project.project_snake_case(fx.orders_raw(spark, sf)), ["id"], _ORDER_BY)
    return merge.merge_upsert(fx.orders_final(spark, sf), src, ["id"], delete_not_matched_by_source=True)


# --- replicate jobs -----------------------------------------------------------

ORDERS_CFG = CONFIGS_BY_NAME["orders"]
_RAW_UNIX_SQL = """
raw_unix as (select *,
  epoch_us("updatedAt") // 1000000 + 3600 as "placingTime",
  case when "orderNo" % 2 = 0 then epoch_us("updatedAt") // 1000000 + 7200 end as "executionTime",
  cast(null as bigint) as "autoBreakEvenTriggeredAt" from fx_orders_raw)"""


def orders_raw_with_unix_seconds(spark, sf):
    """Relational ``order`` rows as staged: camelCase names plus the three
    unix-second columns the table config converts to DATETIME."""
    secs = TM.epoch_seconds_ntz(F.col("updatedAt"))
    return fx.orders_raw(spark, sf).select(
        "*",
        (secs + 3600).alias("placingTime"),
        F.when(F.col("orderNo") % 2 == 0, secs + 7200).alias("executionTime"),
        F.lit(None).cast("bigint").alias("autoBreakEvenTriggeredAt"),
    )


def _ts_of(col: str) -> str:
    return f'make_timestamp({col} * 1000000)'


@register(
    "job_replicate_orders",
    _OFR
    + ","
    + _RAW_UNIX_SQL
    + f""",
 latest as (select id, "orderNo" as order_no, status, total, "updatedAt" as updated_at,
   {_ts_of('"placingTime"')} as placing_time, {_ts_of('"executionTime"')} as execution_time,
   {_ts_of('"autoBreakEvenTriggeredAt"')} as auto_break_even_triggered_at, {RUN_TS_SQL} as _loaded_at
   from raw_unix where "updatedAt" > {_WM_SQL}
   qualify row_number() over (partition by id order by "updatedAt" desc nulls last,
     "orderNo" desc nulls last, status desc nulls last, total desc nulls last) = 1)
select coalesce(s.id, t.id) as id,
 case when s.id is not null then s.order_no else t.order_no end as order_no,
 case when s.id is not null then s.status else t.status end as status,
 case when s.id is not null then s.total else t.total end as total,
 case when s.id is not null then s.updated_at else t.updated_at end as updated_at,
 s.placing_time, s.execution_time, s.auto_break_even_triggered_at, s._loaded_at
from fx_orders_final t full outer join latest s on t.id = s.id""",
)
def q_job_replicate_orders(spark, sf):
    """The ``orders`` table config end to end: window scan from the watermark
    on, without an end -> stamp ``_loaded_at`` -> late filter -> unix-second
    columns to DATETIME -> snake_case -> reconcile the final schema (adds the
    new columns) -> keep-latest by ``updated_at, _loaded_at`` -> MERGE."""
    source, final = orders_raw_with_unix_seconds(spark, sf), fx.orders_final(spark, sf)
    return jobs.replicate_run(source, final, ORDERS_CFG, RUN_TS, RUN_TS)


def _users_snapshot(spark, sf):
    """Relational ``user`` snapshot: customers except every 10th (deleted
    upstream); every 25th delivered twice."""
    c = fx.table(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 0)
    rows = c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("userName"),
        F.col("c_nationkey").alias("nationKey"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("acctBal"),
        F.col("c_mktsegment").alias("mktSegment"),
    )
    return rows.unionByName(rows.filter(F.col("id") % 25 == 0))


def _users_final(spark, sf):
    c = fx.table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("user_name"),
        F.col("c_nationkey").cast("bigint").alias("nation_key"),
        F.lit(0).cast("decimal(12,2)").alias("acct_bal"),
        F.lit("OLD").alias("mkt_segment"),
        F.lit(None).cast("timestamp_ntz").alias("_loaded_at"),
    )


@register(
    "job_replicate_users",
    f"""select c_custkey as id, c_name as user_name, cast(c_nationkey as bigint) as nation_key,
 cast(c_acctbal as decimal(12,2)) as acct_bal, c_mktsegment as mkt_segment, {RUN_TS_SQL} as _loaded_at
 from customer where c_custkey % 10 <> 0""",
)
def q_job_replicate_users(spark, sf):
    """Full snapshot -> snake_case/typed -> keep-latest -> MERGE with delete of
    keys missing from the snapshot. ``nationKey`` is an ``int`` upstream and
    widens to INT64 in the final table."""
    cfg = CONFIGS_BY_NAME["users"]
    types = {"nationKey": ("int", None, None)}
    return jobs.replicate_table(_users_snapshot(spark, sf), _users_final(spark, sf), cfg, RUN_TS, source_types=types)


# --- insert-only merges and key deletes -------------------------------------------

_PRED_SQL = """
pred as (select c_custkey as unique_id, c_name as customer_name, c_mktsegment as segment,
  cast(c_acctbal as decimal(12,2)) as score from customer),
b1 as (select 'b1' as batch_id, 'predictions_part_001.csv' as source_file_name,
  timestamp '2024-01-03 17:00:00' as loaded_at, * from pred where unique_id % 3 <> 0),
b2 as (select 'b2' as batch_id, 'predictions_part_001.csv' as source_file_name,
  timestamp '2024-01-10 17:00:00' as loaded_at, * from pred where unique_id % 3 <> 1)"""


def _prediction_batch(spark, sf, batch_id: str, loaded_at: datetime, cond):
    c = fx.table(spark, sf, "customer").filter(cond)
    rows = c.select(
        F.col("c_custkey").alias("unique_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("score"),
    )
    return project.stamp_audit_columns(
        rows, {"batch_id": batch_id, "source_file_name": "predictions_part_001.csv", "loaded_at": loaded_at}
    ).select("batch_id", "source_file_name", "loaded_at", "unique_id", "customer_name", "segment", "score")


def prediction_batches(spark, sf):
    b1 = _prediction_batch(spark, sf, "b1", datetime(2024, 1, 3, 17), F.col("c_custkey") % 3 != 0)
    b2 = _prediction_batch(spark, sf, "b2", datetime(2024, 1, 10, 17), F.col("c_custkey") % 3 != 1)
    return b1, b2


@register(
    "anti_insert_batch_key",
    "with " + _PRED_SQL + " select * from b1 union all select * from b2",
)
def q_anti_insert_batch_key(spark, sf):
    """Raw table: insert-only on ``(batch_id, unique_id)``; b1, b2, then b2
    again (a redelivery adds nothing)."""
    b1, b2 = prediction_batches(spark, sf)
    raw = b1.filter(F.lit(False))
    for batch in (b1, b2, b2):
        raw = merge.anti_insert(raw, batch, ["batch_id", "unique_id"])
    return raw


@register(
    "anti_insert_key",
    "with " + _PRED_SQL + """
 select unique_id, customer_name, segment, score, loaded_at as _ingested_at from b1
 union all select unique_id, customer_name, segment, score, loaded_at as _ingested_at from b2
 where unique_id not in (select unique_id from b1)""",
)
def q_anti_insert_key(spark, sf):
    """Final table: insert-only on ``unique_id``, ``loaded_at`` becomes
    ``_ingested_at``; the first write wins."""
    b1, b2 = prediction_batches(spark, sf)
    cols = ["unique_id", "customer_name", "segment", "score"]

    def final_rows(b):
        return b.select(*cols, F.col("loaded_at").alias("_ingested_at"))

    final = final_rows(b1).filter(F.lit(False))
    for batch in (b1, b2, b2):
        final = merge.anti_insert(final, final_rows(batch), ["unique_id"])
    return final


_KEYED_SQL = """
hist as (select *, case when o_orderkey % 50 = 0 then null else o_custkey end as k from orders),
newk as (select case when o_orderkey % 40 = 0 then null else o_custkey end as k from orders
  where o_orderdate >= timestamp '2001-01-01')"""


def _keyed(spark, sf):
    o = _orders(spark, sf)
    hist = o.withColumn("k", F.when(F.col("o_orderkey") % 50 == 0, F.lit(None)).otherwise(F.col("o_custkey")))
    new = o.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(
        F.when(F.col("o_orderkey") % 40 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("k")
    )
    return hist, new


@register(
    "semi_delete_by_key",
    "with " + _KEYED_SQL + " select * from hist h where not exists (select 1 from newk n where n.k = h.k)",
)
def q_semi_delete_by_key(spark, sf):
    """``DELETE ... WHERE k IN (SELECT k FROM new WHERE k IS NOT NULL)``;
    target rows with a NULL key survive."""
    hist, new = _keyed(spark, sf)
    return joins.semi_delete_by_key(hist, new, "k")


@register(
    "semi_delete_bloom",
    "with " + _KEYED_SQL + " select * from hist h where not exists (select 1 from newk n where n.k = h.k)",
)
def q_semi_delete_bloom(spark, sf):
    """The same delete; rows that a Bloom filter of the new keys rules out skip
    the join."""
    hist, new = _keyed(spark, sf)
    return replace.delete_by_key(hist, new, "k", keys.BLOOM_BITS)


@register(
    "reconcile_schema",
    O.with_ctes(O.FX_ORDERS_FINAL)
    + """select id, cast(order_no as varchar) as order_no, status, total, updated_at,
 cast(null as timestamp) as _loaded_at from fx_orders_final""",
)
def q_reconcile_schema(spark, sf):
    """Final table brought to the desired schema: ``_loaded_at`` added,
    ``legacy_flag`` dropped, ``order_no`` widened to STRING, and the
    impossible change of ``status`` to BIGINT skipped."""
    from pyspark.sql import types as T

    final = fx.orders_final(spark, sf).withColumn("legacy_flag", F.lit(True))
    desired = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("order_no", T.StringType()),
            T.StructField("status", T.LongType()),
            T.StructField("total", T.DecimalType(18, 2)),
            T.StructField("updated_at", T.TimestampNTZType()),
            T.StructField("_loaded_at", T.TimestampNTZType()),
        ]
    )
    return schema.reconcile_schema(final, desired)


@register(
    "evolve_schema_additive",
    O.with_ctes(O.FX_ORDERS_FINAL)
    + "select *, cast(null as timestamp) as _loaded_at, cast(null as varchar) as note from fx_orders_final",
)
def q_evolve_schema_additive(spark, sf):
    """Only missing columns are added (typed NULL); nothing is dropped."""
    from pyspark.sql import types as T

    desired = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("_loaded_at", T.TimestampNTZType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return schema.evolve_schema_additive(fx.orders_final(spark, sf), desired)
