"""Newline-delimited JSON exports.

Plain and ``.gz`` files are read by Spark's text source (codec chosen by
extension, plain files split across tasks). Archives Spark can't decode by
name -- a ``.zip``, or gzip without a ``.gz`` extension -- are told by their
first bytes, in tasks, and read by a Python data source with one input
partition per archive. It opens an archive as a stream and decodes it batch by
batch, so an archive may have any size and a task holds one batch of lines. The
driver sees file names only.
"""

from __future__ import annotations

import gzip
import io
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewater.functions import semistructured as J
from tidewater.storage import open_fs

FORMAT = "tidewater_archives"
LINE_SCHEMA = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("line", T.StringType())])
BATCH_LINES, BATCH_BYTES = 8192, 8 << 20
BUFFER = 1 << 20
_GZIP, _ZIP = b"\x1f\x8b", b"PK"


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of plain or ``.gz`` text files; invalid UTF-8 bytes are replaced."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def _stream(file, magic: bytes):
    """The decoded bytes of an open export file, as a stream: gzip (all its
    members), the first file of a zip, or the file itself."""
    if magic == _GZIP:
        return gzip.GzipFile(fileobj=file)
    if magic == _ZIP:
        archive = zipfile.ZipFile(file)
        members = [n for n in archive.namelist() if not n.endswith("/")]
        return archive.open(members[0]) if members else None
    return file


def decoded_lines(file) -> Iterator[str]:
    """Lines of an open export file; undecodable bytes are replaced. Only line
    feeds end a record; other separators can stand inside one."""
    magic = file.read(2)
    file.seek(0)
    stream = _stream(file, magic)
    for line in stream or ():
        yield line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", errors="replace")


def line_batches(path: str, lines: Iterator[str]) -> Iterator[pa.RecordBatch]:
    """Batches of at most BATCH_LINES lines and about BATCH_BYTES characters."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held), pa.string()), pa.array(held, pa.string())], ["source_file", "line"])

    for line in lines:
        held.append(line)
        size += len(line)
        if len(held) == BATCH_LINES or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class _RawFile(io.RawIOBase):
    """An Arrow file as Python's archive readers expect one: a seek before the
    start is an OSError."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        return self.file.readinto(target)

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[ArchivePartition]:
        return [ArchivePartition(p) for p in self.paths]

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(partition.path)
        with fs.open_input_file(path) as file:
            yield from line_batches(partition.path, decoded_lines(io.BufferedReader(_RawFile(file), BUFFER)))


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LINE_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(json.loads(self.options["paths"]))


def _names(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Names of the files; their contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")


def read_archive_lines(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Lines of gzip (any name), zip (first member) or plain files, one input
    partition per file."""
    names = sorted(r.path for r in _names(spark, path, glob).collect())
    if not names:
        return spark.createDataFrame([], LINE_SCHEMA)
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(FORMAT).option("paths", json.dumps(names)).load()


def json_objects(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Keep lines that parse to a JSON object: blank, malformed and
    non-object lines are skipped. Adds ``record`` (VARIANT)."""
    return (
        lines.filter(F.length(F.trim(F.col(line_col))) > 0)
        .withColumn("record", J.col(J.parse_record(f"`{line_col}`")))
        .filter(J.col(J.is_object("record")))
    )


def _packed(batches):
    """Whether each named file is an archive, by its first two bytes."""
    for b in batches:
        names, packed = b.column(0).to_pylist(), []
        for name in names:
            if name.endswith(".gz"):  # Spark decodes it by its name
                packed.append(False)
                continue
            fs, path = open_fs(name)
            with fs.open_input_stream(path) as file:
                packed.append(file.read(2) in (_GZIP, _ZIP))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(packed, pa.bool_())], ["path", "packed"])


def _archives(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of (plain files, archives) of an export. Files are opened in
    tasks; names and one flag per file come to the driver."""
    names = _names(spark, path).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    told = names.mapInArrow(_packed, "path string, packed boolean").collect()
    return sorted(r.path for r in told if not r.packed), sorted(r.path for r in told if r.packed)


def scan_ndjson_export(spark: SparkSession, path: str, archives: bool | None = None) -> DataFrame:
    """JSON objects of an export's files. ``archives``: whether files are read
    as archives; by default, those are whose first bytes say so."""
    if archives is not None:
        return json_objects(read_archive_lines(spark, path) if archives else read_text_lines(spark, path))
    plain, packed = _archives(spark, path)
    if not packed:
        return json_objects(read_text_lines(spark, path))
    lines = read_archive_lines(spark, packed).select("line")
    return json_objects(read_text_lines(spark, plain).union(lines) if plain else lines)
