"""Source-shaped views derived from the benchmark tables.

The benchmark ships TPC-H-like tables and an ``events`` stream; the jobs in
this package expect tracking events, subscriber dimensions, replicated
relational rows and NPS export lines. These functions derive those shapes
from the given tables with DataFrame expressions, deterministically, so the
work of every query grows with the input tables. ``FIXTURES.md`` holds the
same definitions in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dedupe import dedupe_latest

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_once(df: DataFrame, **exprs: str) -> DataFrame:
    """Add SQL-expression columns evaluated once per row.

    The columns come out of one-element ``explode`` generators, which later
    filters are not substituted through; as plain projections, a filter on
    a derived column would re-evaluate its whole expression (here: a JSON
    parse) at every reference."""
    out = df
    for name, expr in exprs.items():
        out = out.selectExpr("*", f"explode(array({expr})) AS `{name}`")
    return out


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _txt(c: Column) -> Column:
    return c.cast("string")


def tracking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking events with all 7 event names plus one outside the set;
    ``k % 10`` injects violations: 0 = second flag, 1 = required attribute
    missing, 2 = foreign attribute, 3 = flag missing, 4 = two more flags whose
    values cancel out (the flags still sum to 1), 5 = flag 2 and another -1 (sum
    1, but the own flag isn't 1; quick_buy_sell only).

    Written as SQL text (``selectExpr``): one driver call per step instead of
    one per Column node."""
    ev = with_once(table(spark, sf_dir, "events"), k="CAST(get_json_object(props, '$.k') AS INT)")
    named = with_once(
        ev,
        m="k % 10",
        name="""CASE WHEN event_type = 'signup' THEN 'session_created'
          WHEN event_type = 'click' AND (k div 10) % 2 = 0 THEN 'quick_buy_sell'
          WHEN event_type = 'click' THEN 'partials_taken'
          WHEN event_type = 'view' AND (k div 10) % 2 = 0 THEN 'replay_activated'
          WHEN event_type = 'view' THEN 'news_visibility_clicked'
          WHEN event_type = 'purchase' AND (k div 10) % 2 = 0 THEN 'order_placed'
          WHEN event_type = 'purchase' THEN 'position_managed'
          ELSE 'app_error' END""",
    )

    def flag(event: str) -> str:
        return f"CASE WHEN name = '{event}' AND m <> 3 THEN 1 END"

    others = "m = 4 AND name NOT IN ('replay_activated', 'news_visibility_clicked')"
    return named.selectExpr(
        "event_id",
        "user_id",
        "concat('cust_', CAST(user_id AS STRING)) AS customer_id",
        "ts AS event_timestamp",
        "name",
        "CASE WHEN (name = 'session_created' AND m <> 3) OR (name <> 'session_created' AND m = 0) THEN 1 END"
        " AS is_session_created",
        "CASE WHEN name = 'quick_buy_sell' AND m = 5 THEN 2 WHEN name = 'quick_buy_sell' AND m <> 3 THEN 1 END AS is_quick_buy_sell",
        f"{flag('partials_taken')} AS is_partials_taken",
        "CASE WHEN name = 'position_managed' AND m <> 3 THEN 1 WHEN name = 'quick_buy_sell' AND m = 5 THEN -1 END AS is_position_managed",
        f"CASE WHEN name = 'replay_activated' AND m <> 3 THEN 1 WHEN {others} THEN 2 END AS is_replay_activated",
        f"CASE WHEN name = 'news_visibility_clicked' AND m <> 3 THEN 1 WHEN {others} THEN -2 END AS is_news_visibility_open",
        "CASE WHEN (name = 'order_placed' AND m <> 3) OR (name = 'session_created' AND m = 0) THEN 1 END"
        " AS is_order_placed",
        "CASE WHEN (name = 'session_created' AND m <> 1) OR (name = 'order_placed' AND m = 2)"
        " THEN concat('type_', CAST(k % 3 AS STRING)) END AS created_session_type",
        "CASE WHEN name = 'quick_buy_sell' AND m <> 1 THEN 'buy' END AS quick_buy_sell_type",
        "CASE WHEN name = 'partials_taken' AND m <> 1 THEN CAST(k AS STRING) END AS partials_taken_percentage",
        "CASE WHEN name = 'partials_taken' THEN 'pct' END AS partials_taken_position_amount_type",
        "CASE WHEN name = 'position_managed' AND m <> 1 THEN 'move_sl' END AS position_managed_type",
        "CAST(NULL AS STRING) AS order_has_auto_be",
        "CAST(NULL AS STRING) AS order_has_object_selected",
        "CAST(NULL AS STRING) AS order_has_stop_loss",
        "CASE WHEN name = 'order_placed' OR (name <> 'order_placed' AND m = 2) THEN CAST(k % 4 AS STRING) END"
        " AS order_tag_count",
        "CAST(NULL AS STRING) AS order_has_tag_selected",
        "CAST(NULL AS STRING) AS order_has_take_profit",
        "CAST(NULL AS STRING) AS order_take_profit_type",
        "CAST(NULL AS STRING) AS order_save_type",
    )


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber dimension with NULL and empty ids, NULL and BEGINNER plans."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 11 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 7 = 0 THEN ''"
        " ELSE concat('sub_', CAST(c_custkey AS STRING)) END AS last_subscription_id",
        "CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS STRING) WHEN c_mktsegment = 'BUILDING' THEN 'BEGINNER-M'"
        " ELSE concat('PRO-', c_mktsegment) END AS last_subscription_plan",
    )


WATERMARK_CUTOFF = "2000-01-01 00:00:00"
RAW_FROM = "1999-12-31 00:00:00"


def orders_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final table of the merge jobs: one row per customer, state before 2000."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(WATERMARK_CUTOFF).cast("timestamp_ntz"))
    latest = dedupe_latest(o, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "desc")], tie_break=False)
    return latest.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("order_no"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderdate").alias("updated_at"),
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw staging rows with camelCase names, including rows at the watermark."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(RAW_FROM).cast("timestamp_ntz"))
    return o.select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("orderNo"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderdate").alias("updatedAt"),
    )


def nps_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NPS export lines (one JSON object per line) derived from ``events``.

    ``k % 8`` cycles the score shapes (int, float, padded text, bad text,
    bool-then-valid, null-then-valid, wrong type, empty array); ``k % 9``
    gives JSON-null and empty ids; ids repeat in pairs.
    """
    ev = table(spark, sf_dir, "events").withColumn("k", _k())
    k, et = F.col("k"), F.col("event_type")
    ident = (
        F.when(k % 9 == 8, F.lit("null"))
        .when(k % 9 == 7, F.lit('""'))
        .otherwise(F.concat(F.lit('"e'), _txt(F.expr("event_id div 2")), F.lit('"')))
    )
    responses = (
        F.when(k % 8 == 0, F.concat(F.lit('{"type":"nps_score","value":'), _txt(k % 11), F.lit("}")))
        .when(k % 8 == 1, F.lit('{"type":"nps_score","value":8.9}'))
        .when(k % 8 == 2, F.lit('{"type":"nps_score","value":" 7 "}'))
        .when(k % 8 == 3, F.lit('{"type":"nps_score","value":"n/a"}'))
        .when(k % 8 == 4, F.lit('{"type":"nps_score","value":true},{"type":"nps_score","value":5}'))
        .when(k % 8 == 5, F.lit('{"type":"nps_score","value":null},{"type":"nps_score","value":6}'))
        .when(k % 8 == 6, F.lit('{"type":"text","value":"9"}'))
        .otherwise(F.lit(""))
    )
    line = F.concat(
        F.lit('{"id":'),
        ident,
        F.lit(',"name":"'),
        F.when(et == "error", F.lit("other")).otherwise(F.lit("appcues:v2:step_interaction")),
        F.lit('","timestamp":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('","user_id":"'),
        _txt(F.col("user_id")),
        F.lit('","attributes":{"experienceType":"'),
        F.when(et == "view", F.lit("NPS")).otherwise(F.lit("modal")),
        F.lit('","experienceName":"'),
        F.when(et == "click", F.lit("q1 nps survey")).otherwise(F.lit("tour")),
        F.lit('","interactionData":{"surveyResponses":['),
        responses,
        F.lit("]}}}"),
    )
    return ev.select("event_id", line.alias("line"))
