"""Part files under their own names, with their manifest, in one pass.

A Python data source writes them: each task writes the parts it holds as CSV
files in a folder of its own run and reports, per part, the rows and the least
and greatest event time. The commit, on the driver, gets one small message per
task; it checks that no part came from two tasks, moves the files to their
names and writes ``metadata.json`` from the messages. Nothing is read again,
and a failed or repeated task leaves no file under a part's name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidewater.operators.chunk import PART_PREFIX, PART_SUFFIX, PART_WIDTH
from tidewater.storage import open_fs

FORMAT = "tidewater_parts"


@dataclass
class PartsWritten(WriterCommitMessage):
    """Per part number: [file as written, rows, least time, greatest time]."""

    parts: dict[int, list] = field(default_factory=dict)


def part_name(number: int) -> str:
    return f"{PART_PREFIX}{number:0{PART_WIDTH}d}{PART_SUFFIX}"


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, options, columns: list[str]):
        self.out, self.run = options["path"].rstrip("/"), options["run"]
        self.part_col, self.ts_col, self.batch_id = options["partcol"], options["tscol"], options["batchid"]
        self.columns = [c for c in columns if c != self.part_col]

    @property
    def staging(self) -> str:
        return f"{self.out}/_run-{self.run}"

    def write(self, iterator) -> PartsWritten:
        import pyarrow.compute as pc
        from pyarrow import csv

        fs, folder = open_fs(self.staging)
        fs.create_dir(folder, recursive=True)
        message, number, out = PartsWritten(), None, None
        dialect = csv.WriteOptions(include_header=False, quoting_style="needed")
        try:
            for batch in iterator:
                of = batch.column(self.part_col).to_numpy(zero_copy_only=False)
                at = 0
                while at < len(of):  # rows come in the order of their parts
                    if of[at] != number:
                        if out is not None:
                            out.close()
                        number = int(of[at])
                        if number in message.parts:
                            raise ValueError(f"rows of part {number} are not together")
                        path = f"{folder}/{uuid.uuid4().hex}-{part_name(number)}"
                        message.parts[number] = [path, 0, None, None]
                        out = fs.open_output_stream(path)
                        out.write((",".join(self.columns) + "\n").encode())
                    end = at + int((of[at:] == number).argmin()) if of[-1] != number else len(of)
                    rows = batch.slice(at, end - at).select(self.columns)
                    csv.write_csv(rows, out, dialect)
                    times = pc.min_max(rows.column(self.ts_col)).as_py()
                    part = message.parts[number]
                    part[1] += rows.num_rows
                    for k, pick in ((2, min), (3, max)):
                        known = [t for t in (part[k], times[pick.__name__]) if t is not None]
                        part[k] = pick(known) if known else None
                    at = end
        finally:
            if out is not None:
                out.close()
        return message

    def commit(self, messages) -> None:
        parts: dict[int, list] = {}
        for m in messages:
            twice = parts.keys() & (m.parts if m else {}).keys()
            if twice:
                raise ValueError(f"parts {sorted(twice)} come from two tasks")
            parts |= m.parts if m else {}
        fs, out = open_fs(self.out)
        fs.create_dir(out, recursive=True)
        numbers = sorted(parts)
        for n in numbers:
            fs.move(parts[n][0], f"{out}/{part_name(n)}")
        lows, highs = ([p[k] for p in parts.values() if p[k] is not None] for k in (2, 3))
        meta = {
            "batch_id": self.batch_id if parts else None,
            "expected_file_count": len(parts),
            "expected_file_names": [part_name(n) for n in numbers],
            "row_counts": {part_name(n): parts[n][1] for n in numbers},
            "min_event_timestamp": min(lows, default=None),
            "max_event_timestamp": max(highs, default=None),
        }
        with fs.open_output_stream(f"{out}/metadata.json") as f:
            f.write(json.dumps(meta, indent=2, default=str).encode())
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        """Removes what this run has left in its own folder."""
        fs, folder = open_fs(self.staging)
        if fs.get_file_info(folder).type.name == "Directory":
            fs.delete_dir(folder)


class PartsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options, schema.fieldNames())


def export_parts(
    parts: DataFrame, out_dir: str, columns: list[str], ts_col: str, batch_id: str, part_col: str = "part_no", index_col: str = "row_index"
) -> str:
    """Write each part as one CSV file with a header, ``usage_events_part_001.csv``
    and so on, in index order, and ``metadata.json`` beside them; returns the
    manifest's path. Rows of a part meet in one task, which writes them as they
    come; a part is bounded by its number of rows. NULL is an empty cell, an
    empty text a quoted one. Without rows there are no parts, and the manifest
    says so."""
    if ts_col not in columns:
        raise ValueError(f"{ts_col} must be among the columns")
    spark = parts.sparkSession
    spark.dataSource.register(PartsSource)
    rows = parts.repartition(F.col(part_col)).sortWithinPartitions(part_col, index_col).select(*columns, part_col)
    writer = rows.write.format(FORMAT).mode("append").option("run", uuid.uuid4().hex)
    writer.option("partCol", part_col).option("tsCol", ts_col).option("batchId", batch_id).save(out_dir)
    return f"{out_dir.rstrip('/')}/metadata.json"


def manifest_rows(spark, path: str) -> DataFrame:
    """The manifest as one row per part file."""
    meta = spark.read.schema(
        "batch_id string, expected_file_count bigint, row_counts map<string, bigint>, "
        "min_event_timestamp bigint, max_event_timestamp bigint"
    ).json(path, multiLine=True)
    return meta.select(
        "batch_id", "expected_file_count", F.explode("row_counts").alias("file_name", "row_count"), "min_event_timestamp", "max_event_timestamp"
    )
