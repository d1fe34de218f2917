"""Records of CSV files whose quoted cells hold line breaks, found in parallel.

Spark's text reader splits a large file into byte ranges and a range into
lines; whether a line break ends a record depends on all the quotes before it
in the file. That is a prefix sum:

1. one aggregate counts, per byte range, its quotes (mod 2) and the lines with
   an odd number of them: one small row per range;
2. a running sum over a file's ranges tells whether a range begins inside a
   quoted cell;
3. a range that begins outside, and whose lines all have an even number of
   quotes, holds one record per line and needs nothing more. In the others a
   running sum over the lines of the range numbers the records, and only the
   lines of records that span several are put together.

No file is read by one task only, but compressed ones, which can't be split.
Cells follow RFC 4180: quotes stand around a cell or are doubled inside one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

# Cells as they stand: quotes doubled, spaces and line ends kept, and no text
# that stands for NULL.
CELLS = {
    "escape": '"',
    "nullValue": "__no_null_value__",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "true",
}
_RANGE = ["file", "start"]


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with file, start of their byte range, place in it and quotes. Only
    line feeds end a line; a carriage return before one is cut off later."""
    text = spark.read.option("lineSep", "\n").text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
        quotes.alias("quotes"),
    )


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file_name, record, first)``: the records of each file, line breaks
    inside cells kept; ``first`` marks a file's first record. Empty lines
    between records are left out; a quote that is never closed holds the rest
    of its file in one record."""
    lines = _lines(spark, paths)
    per_range = lines.groupBy(*_RANGE).agg(
        (F.sum("quotes") % 2).alias("parity"), F.count_if(F.col("quotes") % 2 == 1).alias("odd"), F.min("place").alias("head")
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = _landed(per_range.withColumn("open", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2), "csv-ranges")
    known = lines.join(ranges, _RANGE).withColumn("first", (F.col("start") == 0) & (F.col("place") == F.col("head")))
    simple = known.filter("odd = 0 and open = 0")

    order = Window.partitionBy(*_RANGE).orderBy("place")
    inside = F.col("open") + F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    busy = known.filter("odd > 0 or open = 1").withColumn("begins", inside % 2 == 0)
    number = F.sum(F.col("begins").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = _landed(busy.withColumn("number", number).drop("parity", "odd", "head", "open"), "csv-lines")
    begun = numbered.groupBy(*_RANGE).agg(F.max("number").alias("begun"))
    # Lines before a range's first record (number 0) belong to the last one before.
    bases = begun.withColumn("base", F.coalesce(F.sum("begun").over(before), F.lit(0))).drop("begun")
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    parts = numbered.filter(~alone).join(bases, _RANGE).groupBy("file", (F.col("base") + F.col("number")).alias("record_no"))
    spanning = parts.agg(
        F.first("file_name").alias("file_name"),
        F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("held"),
        F.max("first").alias("first"),
    ).select("file_name", F.array_join("held.value", "\n").alias("value"), "first")
    whole = reduce(DataFrame.union, [d.select("file_name", "value", "first") for d in (simple, numbered.filter(alone), spanning)])
    record = F.regexp_replace("value", "\r$", "")
    return whole.select("file_name", record.alias("record"), "first").filter(F.length("record") > 0)


def cells(record: Column, schema: T.StructType) -> Column:
    """A record's cells as a struct of ``schema``."""
    return F.from_csv(record, _ddl(schema), CELLS)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Files with a header, by position, as ``schema``; empty cells are NULL."""
    records = read_records(spark, paths).filter(~F.col("first"))
    row = F.from_csv("record", _ddl(schema), CELLS | {"nullValue": ""})
    return records.select("file_name", row.alias("row")).select("row.*", "file_name")
