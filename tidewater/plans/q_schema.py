"""Queries of the projection operators: typed casts, coercion into existing
column types, transport text, audit stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.functions import time as TM
from tidewater.operators import project
from tidewater.plans.registry import register

_TYPED_SOURCE = {
    "o_orderkey": ("bigint", None, "bigint(20)"),
    "o_custkey": ("int", None, "int(11)"),
    "o_orderstatus": ("varchar", None, "varchar(1)"),
    "o_totalprice": ("decimal", 2, "decimal(12,2)"),
    "o_orderdate": ("datetime", None, "datetime"),
    "o_orderpriority": ("enum", None, "enum('1-URGENT','2-HIGH')"),
    "is_urgent": ("tinyint", None, "tinyint(1)"),
}


@register(
    "project_typed",
    """select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(38,9)) as o_totalprice, o_orderdate,
 o_orderpriority, o_orderpriority like '1-%' as is_urgent,
 make_timestamp((epoch_us(o_orderdate) // 1000000 + 3600) * 1000000) as "placingTime" from orders""",
)
def q_project_typed(spark, sf):
    """Relational source types to Spark types: ``tinyint(1)`` -> BOOLEAN,
    ints -> BIGINT, ``decimal`` scale <= 9 -> DECIMAL(38,9), datetime ->
    TIMESTAMP, enum -> STRING; a listed unix-seconds column -> TIMESTAMP."""
    o = fx.table(spark, sf, "orders")
    src = o.select(
        *[c for c in o.columns],
        F.when(F.col("o_orderpriority").like("1-%"), F.lit(1)).otherwise(F.lit(0)).alias("is_urgent"),
        (TM.epoch_seconds_ntz(F.col("o_orderdate")) + 3600).alias("placingTime"),
    )
    return project.project_typed(src, _TYPED_SOURCE, unix_seconds_columns=["placingTime"])


@register(
    "coerce_to_existing_type",
    """select event_id, json(props)::varchar as props, case when click then 1 else 0 end::bigint as is_click,
 cast(user_id as varchar) as user_id, value
 from (select *, case when event_id % 7 = 0 then null else event_type = 'click' end as click from events)""",
)
def q_coerce_to_existing_type(spark, sf):
    """JSON into an existing STRING column as compact text, BOOL into an
    existing INT64 as 1/0 (NULL -> 0), INT64 into STRING as text."""
    ev = fx.table(spark, sf, "events")
    df = ev.select(
        "event_id",
        "props",
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("event_type") == "click").alias("is_click"),
        "user_id",
        "value",
    )
    desired = {"props": "JSON", "is_click": "BOOL", "user_id": "INT64", "value": "FLOAT64"}
    actual = {"props": "STRING", "is_click": "INT64", "user_id": "STRING", "value": "FLOAT64"}
    return project.coerce_to_existing_type(df, desired, actual)


@register(
    "canonicalize_values",
    """select cast(event_id as bigint) as event_id,
 case when epoch_us(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as ts,
 strftime(cast(ts as date), '%Y-%m-%d') as day, cast(cast(value as decimal(10,2)) as varchar) as amount,
 to_base64(encode(event_type)) as payload from events""",
)
def q_canonicalize_values(spark, sf):
    """Transport text by type: naive datetime, date, decimal, bytes."""
    ev = fx.table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.to_date("ts").alias("day"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("event_type").cast("binary").alias("payload"),
    )
    return project.canonicalize_values(ev)


@register(
    "stamp_audit_columns",
    """select *, timestamp '2024-02-01 05:00:00' as _loaded_at, 'b7' as batch_id, date '2024-02-01' as _run_date
 from orders""",
)
def q_stamp_audit_columns(spark, sf):
    """One load instant and batch tag per run, as literals."""
    o = fx.table(spark, sf, "orders")
    return project.stamp_audit_columns(
        o,
        {
            "_loaded_at": datetime(2024, 2, 1, 5),
            "batch_id": "b7",
            "_run_date": F.lit("2024-02-01").cast("date"),
        },
    )
