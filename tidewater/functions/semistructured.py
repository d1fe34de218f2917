"""JSON / VARIANT rules for exported event records, as SQL expressions.

Records are parsed once with ``try_parse_json`` into ``VARIANT`` (malformed
lines become NULL, never an error); every rule below is a Spark SQL
expression on such a value, evaluated in the JVM.

The builders take and return SQL text (a column name or expression) and are
composed as text; :func:`col` turns the result into a Column with one driver
call. Building the same trees Column by Column costs thousands of py4j round
trips per plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal or exponent number after trimming whitespace (the grammar Python's
# float() accepts for plain numbers; "1_0", "inf" and "nan" do not match).
NUMERIC_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_WS_TRIM = r"^\s+|\s+$"
_SCALAR_KINDS = ("BOOLEAN", "STRING", "BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def col(sql: str) -> Column:
    return F.expr(sql)


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parse_record(line: str) -> str:
    """Line text -> VARIANT, NULL when the text is not valid JSON."""
    return f"try_parse_json({line})"


def _is_object(v: str) -> str:
    # A cast to an empty struct succeeds only for objects and reads no field,
    # unlike schema_of_variant, which walks the whole value.
    return f"(try_variant_get({v}, '$', 'struct<>') IS NOT NULL)"


def _is_array(v: str) -> str:
    return f"(try_variant_get({v}, '$', 'array<variant>') IS NOT NULL)"


def variant_kind(v: str) -> str:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``BOOLEAN``, ``VOID`` (JSON null) or a
    numeric type name; NULL for a missing value."""
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {_is_object(v)} THEN 'OBJECT' "
        f"WHEN {_is_array(v)} THEN 'ARRAY' ELSE schema_of_variant({v}) END"
    )


def is_object(v: str) -> str:
    return f"coalesce({_is_object(v)}, false)"


def field(v: str, path: str) -> str:
    """Sub-value at ``path`` as VARIANT; SQL NULL when missing (a JSON null is
    a VARIANT null, see ``is_variant_null``)."""
    return f"try_variant_get({v}, {_lit(path)}, 'variant')"


def as_text(v: str) -> str:
    return f"try_variant_get({v}, '$', 'string')"


def json_parse_or_keep(value: str) -> str:
    """A string holding valid JSON becomes that value, any other string stays
    a string; non-string values are unchanged."""
    return (
        f"CASE WHEN {variant_kind(value)} = 'STRING' "
        f"THEN coalesce(try_parse_json({as_text(value)}), {value}) ELSE {value} END"
    )


def json_parse_or_keep_text(text: str) -> str:
    """String-column form: valid JSON text becomes its value, any other text
    a VARIANT string."""
    return f"coalesce(try_parse_json({text}), CAST({text} AS VARIANT))"


def json_compact_text(value: str) -> str:
    """Object/array -> compact JSON text, NULL -> NULL, scalar -> its text."""
    return (
        f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN NULL "
        f"WHEN {variant_kind(value)} IN ('OBJECT', 'ARRAY') THEN to_json({value}) "
        f"ELSE {as_text(value)} END"
    )


def stringify_or_null(value: str) -> str:
    """``str(x) or None`` of a record field: missing and ``""`` -> NULL, JSON
    null -> the text ``None``, booleans -> ``True``/``False``, numbers and
    strings -> their text."""
    kind = variant_kind(value)
    return (
        f"CASE WHEN {value} IS NULL THEN NULL "
        f"WHEN is_variant_null({value}) THEN 'None' "
        f"WHEN {kind} = 'BOOLEAN' THEN CASE WHEN try_variant_get({value}, '$', 'boolean') THEN 'True' ELSE 'False' END "
        f"WHEN {kind} IN ('OBJECT', 'ARRAY') THEN to_json({value}) "
        f"ELSE nullif({as_text(value)}, '') END"
    )


def truthy(value: str) -> str:
    """Python truthiness of a JSON value: missing, null, false, 0, "", [] and
    {} are false."""
    kind = variant_kind(value)
    return (
        f"CASE WHEN {value} IS NULL OR is_variant_null({value}) THEN false "
        f"WHEN {kind} = 'STRING' THEN {as_text(value)} <> '' "
        f"WHEN {kind} = 'BOOLEAN' THEN try_variant_get({value}, '$', 'boolean') "
        f"WHEN {kind} IN ('OBJECT', 'ARRAY') THEN to_json({value}) NOT IN ('{{}}', '[]') "
        f"ELSE coalesce(try_variant_get({value}, '$', 'double') <> 0, false) END"
    )


def is_nps_event(attrs: str) -> str:
    """Attributes are an object and ``lower(experienceType) = 'nps'`` or
    ``upper(experienceName)`` contains ``NPS``."""
    etype = f"lower(coalesce({stringify_or_null(field(attrs, '$.experienceType'))}, ''))"
    ename = f"upper(coalesce({stringify_or_null(field(attrs, '$.experienceName'))}, ''))"
    return f"({is_object(attrs)} AND ({etype} = 'nps' OR {ename} LIKE '%NPS%'))"


def first_score_response(attrs: str) -> str:
    """The first survey response of type ``nps_score`` whose value is a
    boolean, number or string (responses with other value types are
    skipped); NULL when there is none or a container is mistyped."""
    responses = f"try_variant_get({attrs}, '$.interactionData.surveyResponses', 'array<variant>')"
    vkind = "schema_of_variant(try_variant_get(r, '$.value', 'variant'))"
    kinds = ", ".join(f"'{k}'" for k in _SCALAR_KINDS)
    decides = (
        f"coalesce({_is_object('r')} AND try_variant_get(r, '$.type', 'string') = 'nps_score' "
        f"AND ({vkind} IN ({kinds}) OR {vkind} LIKE 'DECIMAL%'), false)"
    )
    return f"get(filter({responses}, r -> {decides}), 0)"


def score_of_response(resp: str) -> str:
    """The score a deciding response gives: boolean -> NULL, number ->
    truncated to an integer, string -> trimmed, parsed as a number and
    truncated (unparsable -> NULL). No 0-10 range check."""
    value = f"try_variant_get({resp}, '$.value', 'variant')"
    kind = f"schema_of_variant({value})"
    text = f"regexp_replace({as_text(value)}, {_lit(_WS_TRIM)}, '')"
    number = (
        f"CASE WHEN {kind} = 'STRING' THEN "
        f"CASE WHEN {text} RLIKE {_lit(NUMERIC_TEXT)} THEN try_cast({text} AS DOUBLE) END "
        f"ELSE try_variant_get({value}, '$', 'double') END"
    )
    return (
        f"CASE WHEN {resp} IS NULL OR {kind} = 'BOOLEAN' THEN CAST(NULL AS BIGINT) "
        f"ELSE try_cast(CASE WHEN {number} >= 0 THEN floor({number}) ELSE ceil({number}) END AS BIGINT) END"
    )


def extract_nps_score(attrs: str) -> str:
    """:func:`score_of_response` of :func:`first_score_response`."""
    return score_of_response(first_score_response(attrs))
