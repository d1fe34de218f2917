"""Thin sinks: every operator returns a table state; these write it.

Spark cannot overwrite a path it is reading, so a new table state goes to a
new snapshot folder and a small pointer file names the current one
(readers resolve the pointer). Partition replacement rewrites only the
touched partitions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import scratch_path

POINTER = "_CURRENT"

# Cells keep their spaces, and quotes are doubled, as standard readers expect.
CSV_DIALECT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = _fs(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_record(spark: SparkSession, uri: str) -> tuple[str, str | None]:
    """The path that a file URI names and the file's first CSV record (None
    when it is empty), with the line breaks of its quoted cells; compressed
    files are read through the codec of their name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = codec.createInputStream(stream) if codec is not None else stream
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        record = line = reader.readLine()
        while line is not None and record.count('"') % 2:
            line = reader.readLine()
            record += "" if line is None else "\n" + line
        return path.toString(), record
    finally:
        stream.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """A small control file (pointer, schema.csv, metadata.json) as text."""
    return _read_text(spark, path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    _write_text(spark, path, text)


def write_snapshot(df: DataFrame, table_root: str, fmt: str = "parquet") -> str:
    """Write ``df`` as a new snapshot under ``table_root`` and move the
    pointer to it. Readers of the previous snapshot are not disturbed."""
    spark = df.sparkSession
    snap = os.path.join(table_root, f"snapshot-{os.urandom(6).hex()}")
    df.write.format(fmt).mode("errorifexists").save(snap)
    _write_text(spark, os.path.join(table_root, POINTER), snap)
    return snap


def read_current(spark: SparkSession, table_root: str, fmt: str = "parquet") -> DataFrame | None:
    snap = _read_text(spark, os.path.join(table_root, POINTER))
    return None if snap is None else spark.read.format(fmt).load(snap.strip())


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str], touched: list[str] | None = None) -> None:
    """Dynamic partition overwrite of the rebuilt rows ``df``: only the
    partitions present in ``df`` are rewritten, every other partition of the
    table is left as it is. Partitions named in ``touched`` but absent from
    ``df`` (an empty rebuild) are deleted explicitly, since dynamic overwrite
    would leave their old files in place. With ``touched``, the rebuild is
    landed first, so its input is evaluated once."""
    spark = df.sparkSession
    if touched:
        landed = scratch_path(spark, "rebuilt-partitions")
        df.write.parquet(landed)
        df = spark.read.schema(df.schema).parquet(landed)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    if not touched:
        return
    # One distinct over the partition column: bounded by the partition count.
    present = {str(r[0]) for r in df.select(partition_cols[0]).distinct().collect()}
    for value in touched:
        if str(value) in present:
            continue
        fs, hpath = _fs(spark, os.path.join(path, f"{partition_cols[0]}={value}"))
        if fs.exists(hpath):
            fs.delete(hpath, True)


def export_week(
    df: DataFrame, root: str, week_start: str, week_end: str, fmt: str = "csv", compression: str = "gzip"
) -> str:
    """Write one week's rows to ``root/week_start=../week_end=../``: CSV with
    header and compression (default gzip), or Parquet with Snappy; overwrite."""
    out = os.path.join(root, f"week_start={week_start}", f"week_end={week_end}")
    writer = df.write.mode("overwrite")
    if fmt.lower() == "csv":
        writer.options(**CSV_DIALECT).option("compression", compression).csv(out)
    else:
        writer.option("compression", "snappy").parquet(out)
    return out


def landing_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
