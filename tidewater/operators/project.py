"""Projections: renames, typed casts, coercions, audit stamps, layouts.

All are single ``select`` calls over Column expressions (no Python UDF), so
they fuse into the scan's whole-stage-codegen stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import naming
from tidewater.functions import time as TM
from tidewater.functions import types as TY

LOADED_AT = "_loaded_at"


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Required names match after stripping case and non-alphanumerics
    (``updated_at`` is satisfied by ``updatedAt``); missing -> error."""
    have = {naming.column_key(c) for c in df.columns}
    missing = [r for r in required if naming.column_key(r) not in have]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def snake_case_names(columns: Sequence[str], passthrough: Sequence[str] = (LOADED_AT,)) -> dict[str, str]:
    out: dict[str, str] = {}
    seen: set[str] = set()
    for c in columns:
        target = c if c in passthrough else naming.to_snake_case(c)
        if target in seen:
            raise ValueError(f"duplicate target column name {target!r} (from {c!r})")
        seen.add(target)
        out[c] = target
    return out


def project_snake_case(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Rename every column to snake_case; ``_loaded_at`` passes through."""
    require_columns(df, required)
    names = snake_case_names(df.columns)
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in names.items()])


def project_typed(
    df: DataFrame,
    source_types: Mapping[str, tuple[str, int | None, str | None]],
    unix_seconds_columns: Sequence[str] = (),
) -> DataFrame:
    """Cast every column to the Spark type of its relational source type
    ``(data_type, numeric_scale, column_type)``; listed unix-second columns
    become ``TIMESTAMP_NTZ``. Columns without a declared type pass through."""
    unix_keys = {naming.column_key(c) for c in unix_seconds_columns}
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if naming.column_key(c) in unix_keys:
            out.append(TM.seconds_to_ntz(col).alias(c))
        elif c in source_types:
            dt = TY.source_to_spark(*source_types[c])
            out.append(col.cast(dt).alias(c))
        else:
            out.append(col)
    return df.select(*out)


# (warehouse type of the value, real type of the target column) -> adaptation.
COERCIONS = {
    ("JSON", "STRING"): lambda c: F.to_json(F.parse_json(c.cast("string"))),
    ("STRING", "STRING"): lambda c: c,
    ("BOOL", "INT64"): lambda c: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")),
}


def coerce_expression(col: Column, desired: str, actual: str) -> Column:
    """Adapt a value of warehouse type ``desired`` to a target column whose
    real type is ``actual``: JSON becomes compact JSON text, a boolean 1 or 0
    (NULL: 0), anything else text where text is stored; the rest stays."""
    pair = (desired.upper(), actual.upper())
    otherwise = (lambda c: c.cast("string")) if pair[1] == "STRING" else (lambda c: c)
    return COERCIONS.get(pair, otherwise)(col)


def coerce_to_existing_type(
    df: DataFrame, desired: Mapping[str, str], actual: Mapping[str, str]
) -> DataFrame:
    return df.select(
        *[
            coerce_expression(F.col(c), desired.get(c, "STRING"), actual.get(c, desired.get(c, "STRING"))).alias(c)
            if c in desired
            else F.col(c)
            for c in df.columns
        ]
    )


def canonical_text(col: Column, dt: T.DataType) -> Column:
    """Transport text of one value: decimal as plain text, naive datetime
    ``YYYY-MM-DD HH:MM:SS[.ffffff]``, date ISO, bytes base64; booleans,
    integers, floats and strings stay as they are."""
    if isinstance(dt, T.DecimalType):
        return col.cast("string")
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        # Naive: "YYYY-MM-DD HH:MM:SS[.ffffff]"; zone-aware: the UTC instant
        # in ISO form, "YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00" (session zone UTC).
        sep, suffix = ("'T'", "+00:00") if isinstance(dt, T.TimestampType) else (" ", "")
        whole = F.date_format(col, f"yyyy-MM-dd{sep}HH:mm:ss")
        frac = F.date_format(col, f"yyyy-MM-dd{sep}HH:mm:ss.SSSSSS")
        text = F.when(F.date_format(col, "SSSSSS") == "000000", whole).otherwise(frac)
        return F.when(col.isNull(), F.lit(None)).otherwise(F.concat(text, F.lit(suffix)))
    if isinstance(dt, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(dt, T.BinaryType):
        return F.base64(col)
    if isinstance(dt, T.DayTimeIntervalType):
        return (F.unix_micros(F.lit("1970-01-01 00:00:00Z").cast("timestamp") + col) / F.lit(1e6)).cast("double")
    return col


def canonicalize_values(df: DataFrame) -> DataFrame:
    return df.select(*[canonical_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def stamp_audit_columns(df: DataFrame, stamps: Mapping[str, object]) -> DataFrame:
    """Add one literal per audit column, fixed once per run (never
    ``current_timestamp()`` per action, which would differ between retries)."""
    out = df
    for name, value in stamps.items():
        if isinstance(value, Column):
            out = out.withColumn(name, value)
        elif isinstance(value, datetime):
            out = out.withColumn(name, TM.ts_literal(value))
        else:
            out = out.withColumn(name, F.lit(value))
    return out


# The 26-column curated tracking layout, in order.
TRACKING_LAYOUT = (
    "subscription_id",
    "subscription_plan",
    "timestamp",
    "event_type",
    "customer_id",
    "user_id",
    "is_session_created",
    "is_quick_buy_sell",
    "is_partials_taken",
    "is_position_managed",
    "is_replay_activated",
    "is_news_visibility_clicked",
    "is_order_placed",
    "created_session_type",
    "quick_buy_sell_type",
    "partials_taken_percentage",
    "partials_taken_position_amount_type",
    "position_managed_type",
    "order_has_auto_be",
    "order_has_object_selected",
    "order_has_stop_loss",
    "order_tag_count",
    "order_has_tag_selected",
    "order_has_take_profit",
    "order_take_profit_type",
    "order_save_type",
)
_FLAG_COLUMNS = TRACKING_LAYOUT[6:13]


def project_tracking_columns(df: DataFrame) -> DataFrame:
    """Joined events + subscribers -> the curated 26-column layout:
    ``UNIX_MILLIS(event_timestamp) AS timestamp``, ``name AS event_type``,
    ``is_news_visibility_open AS is_news_visibility_clicked``; text columns as
    STRING, flags as BIGINT. (One ``selectExpr``: a single driver call.)"""
    renamed = {
        "subscription_id": "last_subscription_id",
        "subscription_plan": "last_subscription_plan",
        "timestamp": TM.UNIX_MILLIS_SQL.format(col="event_timestamp"),
        "event_type": "name",
        "is_news_visibility_clicked": "is_news_visibility_open",
    }
    exprs = []
    for c in TRACKING_LAYOUT:
        src = renamed.get(c, f"`{c}`")
        kind = "BIGINT" if c == "timestamp" or c in _FLAG_COLUMNS else "STRING"
        exprs.append(f"CAST({src} AS {kind}) AS `{c}`")
    return df.selectExpr(*exprs)
