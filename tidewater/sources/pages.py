"""Paged JSON API payloads landed as files: one response page per line,
``{"data": [row, ...], "paging": {...}}``.

Rows have no declared schema. Pages are landed once as VARIANT, one row per
element of ``data``, beside the pages that can't be read (quarantine). One
aggregate over the landed rows counts, per field, the kinds of value it holds;
its result has one row per field name and decides the column types. So a
field that appears for the first time becomes a column, a number that is sent
as text keeps its value, and a value that doesn't fit its column widens the
column instead of getting lost.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import semistructured as J
from tidewater.session import scratch_path

ROW, PAGE, REASON = "__row", "__page", "__reason"
INTEGER_TEXT = r"^[+-]?[0-9]{1,18}$"


class PagedRows(NamedTuple):
    """``rows``: one VARIANT per element, with the columns that came beside
    the pages; ``broken``: the text of each unreadable page and the reason."""

    rows: DataFrame
    broken: DataFrame


def _reason(page: str, elements: str) -> str:
    """Why a page can't be read; NULL for a good one. ``elements`` is its
    ``data`` as a list. A page without ``data`` is empty, unless it is an
    error response."""
    data = f"try_variant_get({page}, '$.data', 'variant')"
    return (
        f"CASE WHEN {page} IS NULL THEN 'not JSON' WHEN NOT {J.is_object(page)} THEN 'not an object' "
        f"WHEN {data} IS NULL AND try_variant_get({page}, '$.error', 'variant') IS NOT NULL THEN 'error response' "
        f"WHEN {data} IS NOT NULL AND {elements} IS NULL THEN 'data is not a list' "
        f"WHEN exists({elements}, r -> NOT {J.is_object('r')}) THEN 'a row is not an object' END"
    )


def land_rows(pages: DataFrame, text_col: str = "value", on_broken: str = "fail") -> PagedRows:
    """Land the elements of every page, each page parsed and taken apart once
    (an exploded one-element list is not computed anew by every use). A page
    that can't be read fails the job, or with ``on_broken="quarantine"`` is set
    aside whole; it never vanishes. Blank lines are no pages."""
    if on_broken not in ("fail", "quarantine"):
        raise ValueError(f"on_broken must be fail or quarantine, not {on_broken!r}")
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c != text_col]
    parsed = pages.filter(F.length(F.trim(F.col(text_col))) > 0).select(
        *kept, F.col(text_col).alias(PAGE), F.explode(F.array(J.col(J.parse_record(f"`{text_col}`")))).alias("__p")
    )
    apart = parsed.select("*", F.explode(F.array(F.expr("try_variant_get(__p, '$.data', 'array<variant>')"))).alias("__e"))
    judged = apart.select(*kept, PAGE, "__e", F.explode(F.array(F.expr(_reason("__p", "__e")))).alias(REASON))
    if on_broken == "fail":
        fault = F.raise_error(F.concat(F.lit("page can't be read: "), F.col(REASON), F.lit(": "), F.substring(PAGE, 1, 200)))
        judged = judged.withColumn(REASON, F.when(F.col(REASON).isNotNull(), fault.cast("string")))
    # A page that can't be read is one row without an element; the others leave their text behind.
    elements = F.expr(f"CASE WHEN {REASON} IS NULL THEN __e ELSE array(cast(null AS variant)) END")
    text = F.when(F.col(REASON).isNotNull(), F.col(PAGE)).alias(PAGE)
    path = scratch_path(spark, "paged-rows")
    judged.select(*kept, text, REASON, elements.alias("__e")).select(*kept, F.explode("__e").alias(ROW), PAGE, REASON).write.parquet(path)
    landed = spark.read.parquet(path)
    return PagedRows(
        landed.filter(F.col(REASON).isNull()).select(*kept, ROW),
        landed.filter(F.col(REASON).isNotNull()).select(*kept, F.col(PAGE).alias("page"), F.col(REASON).alias("reason")),
    )


def field_kinds(rows: DataFrame, texts_of: list[str] | None = None) -> DataFrame:
    """Per field name of the landed rows: how many values of each kind it has.
    The exploded fields are counted by name and kind, a kind told once per
    value, before the shuffle; one row per field name. With ``texts_of`` only
    the texts of those fields are tried as numbers."""
    integer = "(kind = 'BIGINT' OR kind RLIKE '^DECIMAL[(]([1-9]|1[0-8]),0[)]$')"
    # A landed column may hold an integer as a decimal without a scale.
    whole = "kind RLIKE '^DECIMAL.*,0[)]$'"
    counts = {
        "booleans": "kind = 'BOOLEAN'",
        "integers": integer,
        "numbers": f"kind IN ('DOUBLE', 'FLOAT') OR kind LIKE 'DECIMAL%' AND NOT {whole}",
        "texts": f"kind = 'STRING' OR {whole} AND NOT {integer}",
        "integer_texts": "like = 'integer'",
        "number_texts": "like IN ('integer', 'number')",
        "nested": "kind IN ('OBJECT', 'ARRAY')",
    }
    # Nothing but a plain integer or number matches; an integer is a number, too.
    tried = "kind = 'STRING'"
    if texts_of is not None:
        tried += f" AND key IN ({', '.join(map(J._lit, texts_of))})" if texts_of else " AND false"
    text = f"CASE WHEN {tried} THEN {J.as_text('value')} END"
    like = f"CASE WHEN text RLIKE '{J.NUMERIC_TEXT}' THEN CASE WHEN text RLIKE '{INTEGER_TEXT}' THEN 'integer' ELSE 'number' END END"
    fields = rows.select(ROW).lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(ROW).outer()))
    told = fields.select("key", "value", F.expr("substring_index(schema_of_variant(value), '<', 1)").alias("kind"))
    told = told.select("key", "kind", F.expr(text).alias("text"))
    held = told.groupBy(F.col("key").alias("name"), "kind", F.expr(like).alias("like")).agg(F.count(F.lit(1)).alias("n"))
    return held.groupBy("name").agg(*[F.expr(f"sum(CASE WHEN {c} THEN n ELSE 0L END) AS {name}") for name, c in counts.items()])


def column_type(kinds: T.Row, known: T.DataType | None = None) -> T.DataType:
    """The type that holds every value of a field. Without a known type: the
    kind that all values share, text where kinds differ; nested values are JSON
    text, and so are integers beyond 64 bits. A known type stays as long as
    every value fits it, numbers sent as text included; else the column widens,
    integers to doubles, anything to text."""
    k = kinds.asDict()
    if known is None:
        plain = not (k["texts"] or k["nested"])
        if plain and k["booleans"] and not (k["integers"] or k["numbers"]):
            return T.BooleanType()
        if plain and not k["booleans"] and (k["integers"] or k["numbers"]):
            return T.DoubleType() if k["numbers"] else T.LongType()
        return T.StringType()
    numeric = not (k["booleans"] or k["nested"]) and k["texts"] == k["number_texts"]
    if isinstance(known, T.LongType) and numeric:
        return known if not k["numbers"] and k["texts"] == k["integer_texts"] else T.DoubleType()
    if isinstance(known, T.DoubleType) and numeric:
        return known
    only_booleans = k["booleans"] and not (k["integers"] or k["numbers"] or k["texts"] or k["nested"])
    empty = not any(k[c] for c in ("booleans", "integers", "numbers", "texts", "nested"))
    return known if empty or (isinstance(known, T.BooleanType) and only_booleans) else T.StringType()


def inferred_schema(rows: DataFrame, known: T.StructType | None = None) -> T.StructType:
    """Columns of the landed rows: the known ones in their order, then the new
    ones by name; a field named like a column beside the pages gives way to
    it. One row per field name comes to the driver."""
    have = {f.name: f.dataType for f in known.fields} if known else {}
    # Whether a text is a number matters to columns that hold numbers.
    numeric = [n for n, t in have.items() if isinstance(t, (T.LongType, T.DoubleType))]
    found = {r["name"]: r for r in field_kinds(rows, numeric).collect() if r["name"] not in rows.columns}
    typed = [T.StructField(n, column_type(found[n], t) if n in found else t) for n, t in have.items()]
    return T.StructType(typed + [T.StructField(n, column_type(found[n])) for n in sorted(found.keys() - have.keys())])


def typed_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed rows as columns of ``schema``, beside the columns they came
    with. JSON null and a missing field are NULL."""
    kept = [c for c in rows.columns if c != ROW]
    cells = []
    for f in schema.fields:
        path = '$["' + f.name + '"]'
        # As text, objects and lists are compact JSON, and JSON null is NULL.
        cells.append(F.expr(f"try_variant_get({ROW}, {J._lit(path)}, '{f.dataType.simpleString()}')").alias(f.name))
    return rows.select(*kept, *cells)


def grow_table(table: DataFrame, schema: T.StructType) -> DataFrame:
    """``table`` with its columns widened to ``schema``'s types and the new
    columns (NULL for old rows) at the end."""
    types, have = {f.name: f.dataType for f in schema.fields}, set(table.columns)
    old = [F.col(f"`{c}`").cast(types.get(c, table.schema[c].dataType)).alias(c) for c in table.columns]
    return table.select(*old, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in have])


def flatten_paged_payload(
    pages: DataFrame, known: T.StructType | None = None, text_col: str = "value", on_broken: str = "fail"
) -> DataFrame:
    """The ``data`` arrays of all pages as one table of typed rows; ``known``
    names columns whose types are settled already."""
    rows = land_rows(pages, text_col, on_broken).rows
    return typed_rows(rows, inferred_schema(rows, known))


def _spark_type(text: str) -> T.DataType:
    """The type of a merged VARIANT schema. Kinds that don't agree (VARIANT),
    and values that are always null, are text; whole decimals are integers,
    other decimals doubles."""
    ddl = re.sub(r"OBJECT<>", "STRING", text).replace("OBJECT<", "STRUCT<")
    ddl = re.sub(r"\b(VARIANT|VOID)\b", "STRING", ddl)
    ddl = re.sub(r"DECIMAL\((\d+),(\d+)\)", lambda m: "BIGINT" if m[2] == "0" and int(m[1]) <= 18 else "DOUBLE", ddl)
    return T.StructType.fromDDL(f"v {ddl}")["v"].dataType


def infer_json(spark: SparkSession, path: str | list[str], on_broken: str = "fail") -> DataFrame:
    """Newline-delimited JSON objects as a table, schema and all from one pass
    over the input: the lines are parsed to VARIANT and landed, and the schema
    is merged by an aggregate that observes them on the way. Objects are
    structs and lists arrays; where the kinds of a field differ it is text,
    integers and decimals together are doubles. Lines that hold no object fail
    the job, or are left out with ``on_broken="skip"``; blank lines are none."""
    if on_broken not in ("fail", "skip"):
        raise ValueError(f"on_broken must be fail or skip, not {on_broken!r}")
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parsed = lines.select("value", F.explode(F.array(J.col(J.parse_record("value")))).alias(ROW))
    good = J.is_object(ROW)
    if on_broken == "fail":
        fault = "raise_error(concat('no JSON object: ', substring(value, 1, 200)))"
        rows = parsed.filter(F.expr(f"CASE WHEN {good} THEN true ELSE {fault} IS NULL END"))
    else:
        rows = parsed.filter(F.expr(good))
    seen, landed = Observation(), scratch_path(spark, "json-rows")
    rows.select(ROW).observe(seen, F.schema_of_variant_agg(ROW).alias("found")).write.parquet(landed)
    found = _spark_type(seen.get["found"]) if seen.get["found"] else T.StringType()
    fields = found.fields if isinstance(found, T.StructType) else []
    cells = [F.expr(f"try_variant_get({ROW}, " + J._lit(f'$["{f.name}"]') + f", '{f.dataType.simpleString()}')").alias(f.name) for f in fields]
    return spark.read.parquet(landed).select(*cells)


def pages_from_rows(rows: DataFrame, page_key: Column, json_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Pack rows into response pages, one page per value of ``page_key`` and
    of the columns ``keep`` (the key must bound the page size, as an API page
    limit does). ``json_col`` holds a row's JSON text, if it is not built from
    all columns."""
    text = F.col(json_col) if json_col else F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    of_page = [*(keep or []), page_key.alias("__page")]
    grouped = rows.groupBy(*of_page).agg(F.coalesce(F.listagg(text, F.lit(",")), F.lit("")).alias("__data"))
    page = F.concat(
        F.lit('{"data":['),
        F.col("__data"),
        F.lit('],"paging":{"after":"'),
        F.col("__page").cast("string"),
        F.lit('"}}'),
    )
    return grouped.select(*(keep or []), page.alias("page"))


def land_pages(pages: DataFrame, path: str) -> str:
    """Pages as text files; pages that were fetched by day (a ``day`` column)
    as a table in the order of their days, so a window reads its own row
    groups only."""
    lines = pages.withColumnRenamed("page", "value")
    if "day" in pages.columns:
        lines.repartitionByRange("day").sortWithinPartitions("day").write.option("parquet.block.size", 8 << 20).parquet(path)
    else:
        lines.write.text(path)
    return path
