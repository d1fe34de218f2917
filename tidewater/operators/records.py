"""Exported event records -> typed rows (the NPS survey table)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import semistructured as J

# Fixed value: the exported event name that carries survey interactions.
NPS_EVENT_NAME = "appcues:v2:step_interaction"

NPS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("_run_date", T.DateType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("experience_name", T.StringType()),
        T.StructField("experience_type", T.StringType()),
        T.StructField("nps_score", T.LongType()),
        T.StructField("attributes", T.StringType()),
        T.StructField("identity", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("_ingested_at", T.TimestampNTZType()),
    ]
)


def compact_json_text(line: str, path: str, value: str) -> str:
    """Compact JSON text of the field at ``path``, key order as written.
    A string holding JSON is parsed and compacted; other strings stay as
    they are; NULL/missing -> NULL."""
    kind = J.variant_kind(value)
    text = J.as_text(value)
    return (
        f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN NULL "
        f"WHEN {kind} IN ('OBJECT', 'ARRAY') THEN get_json_object({line}, '{path}') "
        f"WHEN {kind} = 'STRING' AND {J.variant_kind(f'try_parse_json({text})')} IN ('OBJECT', 'ARRAY') "
        f"THEN get_json_object({text}, '$') "
        f"ELSE {text} END"
    )


def parse_iso_timestamp(text: str) -> str:
    """ISO-8601 text (``Z`` or offset allowed) -> UTC wall-clock
    ``TIMESTAMP_NTZ``; the session zone is UTC (see ``tidewater.session``)."""
    return f"CAST(try_to_timestamp({text}) AS TIMESTAMP_NTZ)"


def with_once(df: DataFrame, **exprs: str) -> DataFrame:
    """Add SQL-expression columns computed once per row.

    A plain projection lets the optimizer substitute the expression into every
    later predicate or expression that references the column (a JSON parse
    would then run once per reference). The columns come out of a one-row
    ``explode`` of a one-element array instead (a Generate node, code-generated),
    which nothing is substituted through."""
    out = df
    for name, expr in exprs.items():
        out = out.selectExpr("*", f"explode(array({expr})) AS `{name}`")
    return out


def nps_rows(
    lines: DataFrame,
    run_date: date,
    ingested_at: datetime,
    line_col: str = "line",
    event_name: str = NPS_EVENT_NAME,
    partitions: int | None = None,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """One row per NPS answer: exact event name, attributes an object
    describing an NPS experience, a score, a truthy timestamp.

    Parsing is what this costs. Where the input is not split (one archive, a
    file with one row group), ``partitions`` deals the lines out before. With
    ``days`` (first and last), only the timestamp is read of lines of other
    days.

    Stages, each computed once per row: parse the record; resolve the
    attributes (JSON text inside a string is parsed); pick the deciding
    survey response; then filter and project the kept rows."""
    rec = "__rec"
    narrow = lines.selectExpr(f"`{line_col}` AS __line")
    if partitions is not None:
        narrow = narrow.repartition(partitions)
    parsed = with_once(narrow, __rec=J.parse_record("__line"))
    objects = parsed.filter(J.col(J.is_object(rec)))
    if days is not None:
        stamp = parse_iso_timestamp(J.stringify_or_null(J.field(rec, "$.timestamp")))
        objects = with_once(objects, __at=stamp).filter(F.to_date("__at").between(*map(F.lit, days)))
    attrs_raw = J.field(rec, "$.attributes")
    staged = with_once(objects, __attrs_raw=attrs_raw)
    staged = with_once(staged, __attrs=J.json_parse_or_keep("__attrs_raw"))
    staged = with_once(staged, __resp=J.first_score_response("__attrs"))
    staged = with_once(staged, __score=J.score_of_response("__resp"))
    name = J.field(rec, "$.name")
    keep = (
        f"{J.variant_kind(name)} = 'STRING' AND {J.as_text(name)} = '{event_name}' "
        f"AND {J.is_nps_event('__attrs')} AND __score IS NOT NULL AND {J.truthy(J.field(rec, '$.timestamp'))}"
    )
    ingested = ingested_at.isoformat(sep=" ")
    return staged.filter(J.col(keep)).selectExpr(
        f"{J.stringify_or_null(J.field(rec, '$.id'))} AS event_id",
        f"'{event_name}' AS event_name",
        f"{parse_iso_timestamp(J.stringify_or_null(J.field(rec, '$.timestamp')))} AS event_timestamp",
        f"DATE'{run_date.isoformat()}' AS _run_date",
        f"{J.stringify_or_null(J.field(rec, '$.user_id'))} AS user_id",
        f"{J.stringify_or_null(J.field(rec, '$.account_id'))} AS account_id",
        f"{J.stringify_or_null(J.field('__attrs', '$.experienceName'))} AS experience_name",
        f"{J.stringify_or_null(J.field('__attrs', '$.experienceType'))} AS experience_type",
        "__score AS nps_score",
        f"{compact_json_text('__line', '$.attributes', '__attrs_raw')} AS attributes",
        f"{compact_json_text('__line', '$.identity', J.field(rec, '$.identity'))} AS identity",
        "get_json_object(__line, '$') AS raw_payload",
        f"TIMESTAMP_NTZ'{ingested}' AS _ingested_at",
    )


NPS_ORDER = [("event_timestamp", "desc"), ("_ingested_at", "desc")]
