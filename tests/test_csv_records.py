"""CSV records with line breaks in quoted cells, over many small byte ranges."""

from __future__ import annotations

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import types as T

from tidewater.sinks import files
from tidewater.sources import csv_declared as CSV
from tidewater.sources import csv_records


@pytest.fixture
def small_ranges(spark):
    """Files are split every 64 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(seed, n=120):
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choice(['a', 'é', ' ', ',', '"', "\n", "\r\n", "x", "1", ""]) for _ in range(rng.choice([0, 1, 3, 9, 90])))
    return [[str(i), cell() if rng.random() < 0.4 else "plain", cell() if rng.random() < 0.2 else f"c{i}"] for i in range(n)]


def _text(rows, end="\r\n", header=("id", "a", "b")):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([list(header), *rows])
    return out.getvalue()


FIELDS = [CSV.DeclaredField("id", "INT64"), CSV.DeclaredField("a", "STRING"), CSV.DeclaredField("b", "STRING")]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_a_sequential_reader(spark, small_ranges, tmp_path, end):
    want = []
    for k in range(3):
        rows = _rows(k)
        want += [(int(r[0]), r[1], r[2], f"f{k}.csv") for r in rows]
        (tmp_path / f"f{k}.csv").write_bytes((b"\xef\xbb\xbf" if k == 1 else b"") + _text(rows, end).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    df = CSV.read_declared_csv(spark, str(tmp_path / "*.csv"), FIELDS, "b")
    assert sorted((r.id, r.a, r.b, r.source_file_name) for r in df.collect()) == sorted(want)
    assert csv_records._lines(spark, str(tmp_path / "*.csv")).rdd.getNumPartitions() > 20


def test_simple_files_need_no_window(spark, small_ranges, tmp_path):
    (tmp_path / "f.csv").write_text("id,a,b\n" + "".join(f'{i},"x ""y"" z",\n\n' for i in range(50)))
    got = csv_records.read_records(spark, str(tmp_path)).collect()
    assert len(got) == 51 and sum(r.first for r in got) == 1
    rows = CSV.read_declared_csv(spark, str(tmp_path), FIELDS).collect()
    assert sorted(map(tuple, rows)) == [(i, 'x "y" z', "") for i in range(50)]


def test_compressed_and_unclosed(spark, tmp_path):
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(_text([["1", "x\ny", "z"]]).encode()))
    (tmp_path / "g.csv").write_text('id,a,b\n2,"never\nclosed\n3,x,y')
    got = {r.id: r.a for r in CSV.read_declared_csv(spark, str(tmp_path), FIELDS).collect()}
    assert got[1] == "x\ny" and got[2].startswith("never\nclosed") and len(got) == 2


def test_header_with_line_break(spark, tmp_path):
    (tmp_path / "f.csv").write_text(_text([["1", "u", "v"]], header=("id", "a\nb", "b")))
    fields = [FIELDS[0], CSV.DeclaredField("a\nb", "STRING")]
    assert [tuple(r) for r in CSV.read_declared_csv(spark, str(tmp_path), fields).collect()] == [(1, "u")]


def test_written_cells_come_back(spark, small_ranges, tmp_path):
    rows = [(i, a or None, b or None) for i, (_, a, b) in enumerate(_rows(9))]
    schema = T.StructType.fromDDL("id long, a string, b string")
    out = files.export_week(spark.createDataFrame(rows, schema), str(tmp_path / "out"), "2024-01-01", "2024-01-08")
    got = csv_records.read_csv(spark, out, schema).drop("file_name").collect()
    assert sorted(map(tuple, got)) == rows


def test_repeated_columns_are_lists(spark, tmp_path):
    (tmp_path / "f.csv").write_text(_text([["1", "[1, 2, null]", '["x","y, z"]'], ["2", "", "[]"]]))
    fields = [FIELDS[0], CSV.DeclaredField("a", "INT64", "REPEATED"), CSV.DeclaredField("b", "STRING", "REPEATED")]
    assert sorted(tuple(r) for r in CSV.read_declared_csv(spark, str(tmp_path), fields).collect()) == [(1, [1, 2, None], ["x", "y, z"]), (2, [], [])]
    (tmp_path / "f.csv").write_text(_text([["1", "7", "[]"]]))
    with pytest.raises(Exception, match="not a list"):
        CSV.read_declared_csv(spark, str(tmp_path), fields).collect()
    (tmp_path / "f.csv").write_text(_text([["1", '["u"]', "[]"]]))
    with pytest.raises(Exception, match="not a INT64"):
        CSV.read_declared_csv(spark, str(tmp_path), fields).collect()
