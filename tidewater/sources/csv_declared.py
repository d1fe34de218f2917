"""CSV batches described by a ``schema.csv`` file.

The schema file is a handful of rows (one per column), so it is read on the
driver through the file system API to build the declared fields; the data
files are read as records (``csv_records``: quoted cells may hold line breaks),
one multi-path scan per distinct header, and projected onto that schema with
Column expressions.
"""

from __future__ import annotations

import csv
import io
import re
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import types as TY
from tidewater.functions import time as TM
from tidewater.sources import csv_records

# Headers of schema.csv and what they stand for, best first.
HEADERS = {
    "name": ("name", "field", "field_name", "column", "column_name"),
    "type": ("type", "data_type", "field_type"),
    "mode": ("mode", "nullable", "field_mode"),
    "description": ("description",),
}
# Cells of the mode column; any other cell means NULLABLE.
MODES = {
    "NULLABLE": "NULLABLE",
    "TRUE": "NULLABLE",
    "YES": "NULLABLE",
    "REQUIRED": "REQUIRED",
    "FALSE": "REQUIRED",
    "NO": "REQUIRED",
    "REPEATED": "REPEATED",
}
# Accepted BOOL cells.
TRUE_CELLS, FALSE_CELLS = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")
# Accepted TIMESTAMP text layouts.
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")


@dataclass(frozen=True)
class DeclaredField:
    name: str
    type_name: str  # warehouse type
    mode: str = "NULLABLE"
    description: str | None = None

    @property
    def item_type(self) -> T.DataType:
        return TY.WAREHOUSE_TO_SPARK[self.type_name]

    @property
    def spark_type(self) -> T.DataType:
        return T.ArrayType(self.item_type) if self.mode == "REPEATED" else self.item_type


def header_roles(header: list[str]) -> dict[str, str]:
    """Role -> the header that plays it."""
    place = {word: (role, rank) for role, words in HEADERS.items() for rank, word in enumerate(words)}
    known = [(place[word], h) for h in header if (word := h.strip().lower()) in place]
    return {role: h for (role, _), h in sorted(known, reverse=True)}  # the best of a role is set last


def parse_schema_rows(header: list[str], rows: list[dict]) -> list[DeclaredField]:
    """The declared fields of a schema file; rows without a name are comments,
    types that are not known are STRING."""
    roles = header_roles(header)
    if not {"name", "type"} <= roles.keys():
        raise ValueError(f"schema file: headers {header} name no column for names or none for types")
    table = [{role: (row.get(h) or "").strip() for role, h in roles.items()} for row in rows]
    fields = [
        DeclaredField(
            cell["name"],
            TY.declared_to_warehouse(cell["type"] or None),
            MODES.get(cell.get("mode", "").upper(), "NULLABLE"),
            cell.get("description") or None,
        )
        for cell in table
        if cell["name"]
    ]
    if not fields:
        raise ValueError("schema file: no row declares a field")
    return fields


def read_schema_file(spark: SparkSession, path: str) -> list[DeclaredField]:
    """schema.csv -> declared fields. The control file is a few rows, so it
    is read through the file system API rather than as a Spark job; a BOM
    in the header is stripped."""
    from tidewater.sinks.files import read_text_file

    text = read_text_file(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    reader = csv.DictReader(io.StringIO(text.lstrip("\ufeff")))
    if not reader.fieldnames:
        raise ValueError("schema.csv is empty")
    return parse_schema_rows(list(reader.fieldnames), list(reader))


def normalize_csv_timestamp(text: Column, fail: bool = True) -> Column:
    """Exactly ``YYYY-MM-DDTHH:MM:SS`` or with a space; empty -> NULL; any
    other text fails the batch (``fail=False``: NULL instead)."""
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS]).cast("timestamp_ntz")
    bad = text.isNotNull() & (text != F.lit("")) & parsed.isNull()
    if fail:
        return F.when(bad, F.raise_error(F.concat(F.lit("Unsupported timestamp value: "), text))).otherwise(parsed)
    return F.when(bad, F.lit(None).cast("timestamp_ntz")).otherwise(parsed)


def _loud(value: Column, text: Column, blank: Column, f: DeclaredField) -> Column:
    """``value``, but a cell that is not blank and has none fails the batch."""
    what = F.concat(F.lit(f"column {f.name}: not a {f.type_name}: "), text)
    return F.when(blank, F.lit(None)).when(value.isNull(), F.raise_error(what).cast(f.item_type)).otherwise(value)


def _repeated(text: Column, f: DeclaredField) -> Column:
    """A cell of a REPEATED column: a JSON list, each item as a cell of its
    own; an empty cell is an empty list, other text fails the batch."""
    items = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    what = F.concat(F.lit(f"column {f.name}: not a list: "), text)
    item = DeclaredField(f.name, f.type_name)
    listed = F.transform(items, lambda x: F.when(x.isNotNull(), typed_value(x, item).cast(f.item_type)))
    empty = F.array().cast(f.spark_type)
    is_list = F.ltrim(text).startswith("[") & items.isNotNull()
    return F.when(F.coalesce(text, F.lit("")) == "", empty).when(is_list, listed).otherwise(F.raise_error(what).cast(f.spark_type))


def typed_value(text: Column, f: DeclaredField) -> Column:
    """One CSV cell -> its declared type. Strings stay ``''`` when empty, other
    types read empty as NULL, and a REPEATED column reads a JSON list. A cell
    that does not parse fails the batch, and so does an empty one of a REQUIRED
    column that is not text."""
    if f.mode == "REPEATED":
        return _repeated(text, f)
    if f.type_name in ("STRING", "JSON", "TIME"):
        return F.coalesce(text, F.lit(""))
    blank = text.isNull() | (text == F.lit(""))
    word = F.lower(F.trim(text))
    if f.type_name == "TIMESTAMP":
        value = normalize_csv_timestamp(text)
    elif f.type_name == "BOOL":
        truth = F.when(word.isin(*TRUE_CELLS), F.lit(True)).when(word.isin(*FALSE_CELLS), F.lit(False))
        value = _loud(truth, text, blank, f)
    elif f.type_name == "BYTES":
        value = _loud(F.try_to_binary(text, F.lit("base64")), text, blank, f)
    else:
        value = _loud(text.try_cast(f.item_type), text, blank, f)
    if f.mode == "REQUIRED":
        return F.coalesce(value, F.raise_error(F.lit(f"column {f.name}: REQUIRED, but empty")).cast(f.spark_type))
    return value


def files_by_header(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the data files that begin with it. Only the first record of
    each file is read, through the file system API; empty files are left out."""
    from tidewater.sinks.files import first_record

    groups: dict[tuple[str, ...], list[str]] = {}
    for uri in sorted(spark.read.text(paths).inputFiles()):
        path, line = first_record(spark, uri)
        if line:
            header = next(csv.reader([line.lstrip("\ufeff")]))
            groups.setdefault(tuple(header), []).append(path)
    return groups


def _text_columns(header: tuple[str, ...]) -> T.StructType:
    """All columns of a file as text; of equal names the last one counts."""
    last = {name: i for i, name in enumerate(header)}
    return T.StructType([T.StructField(n if last[n] == i else f"{n} #{i}", T.StringType()) for i, n in enumerate(header)])


def read_declared_csv(
    spark: SparkSession,
    paths: str | list[str],
    fields: list[DeclaredField],
    batch_id: str | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """All data files of a batch, projected onto the declared schema by the
    header of each file: unknown columns ignored, missing columns empty. Files
    with equal headers are one scan. With ``batch_id`` the raw audit columns
    lead: ``batch_id``, ``source_file_name``, ``loaded_at``."""
    audit: list[Column] = []
    if batch_id is not None:
        audit = [
            F.lit(batch_id).alias("batch_id"),
            F.col("file_name").alias("source_file_name"),
            TM.ts_literal(loaded_at or datetime(1970, 1, 1)).alias("loaded_at"),
        ]

    def projected(raw: DataFrame) -> DataFrame:
        present = set(raw.columns)
        cells = [F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast("string") for f in fields]
        return raw.select(*audit, *[typed_value(c, f).cast(f.spark_type).alias(f.name) for c, f in zip(cells, fields)])

    def read(header: tuple[str, ...], files: list[str]) -> DataFrame:
        records = csv_records.read_records(spark, files).filter(~F.col("first"))
        return records.select(csv_records.cells(F.col("record"), _text_columns(header)).alias("__row"), "file_name").select("__row.*", "file_name")

    parts = [projected(read(header, files)) for header, files in files_by_header(spark, paths).items()]
    if not parts:
        return projected(spark.range(0).select(F.lit("").alias("file_name")))
    return reduce(DataFrame.union, parts)


def latest_batch(
    spark: SparkSession,
    root: str,
    data_glob: str = "predictions_part_*.csv",
    controls: tuple[str, ...] = ("metadata.json", "schema.csv"),
) -> str:
    """Newest batch folder under ``root`` by (newest file time, name) among
    folders holding at least one data file and every control file. Only file
    metadata is listed (the binary source does not read contents that are
    not selected); one row comes back to the driver."""
    listing = (
        spark.read.format("binaryFile")
        .load(root.rstrip("/") + "/*/*")
        .select("path", "modificationTime")
        .withColumn("file", F.element_at(F.split("path", "/"), -1))
        .withColumn("batch", F.element_at(F.split("path", "/"), -2))
    )
    exact = "^" + ".*".join(re.escape(part) for part in data_glob.split("*")) + "$"
    per_batch = listing.groupBy("batch").agg(
        F.count_if(F.col("file").rlike(exact)).alias("n_data"),
        *[F.max(F.col("file") == F.lit(c)).alias(f"has_{i}") for i, c in enumerate(controls)],
        F.max("modificationTime").alias("mtime"),
        F.first(F.regexp_replace("path", "/[^/]*$", "")).alias("batch_path"),
    )
    valid = per_batch.filter((F.col("n_data") > 0) & F.expr(" and ".join(f"has_{i}" for i in range(len(controls)))))
    best = valid.agg(F.max_by("batch_path", F.struct("mtime", "batch")).alias("path")).collect()[0]["path"]
    if best is None:
        raise FileNotFoundError(f"no complete batch folder under {root}")
    return best
