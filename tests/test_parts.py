"""Part files under their own names, their manifest, and row numbers."""

from __future__ import annotations

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import chunk
from tidewater.operators.project import TRACKING_LAYOUT
from tidewater.plans import q_export
from tidewater.sinks import parts, tables

ROWS = [(i, None if i % 5 == 0 else i * 7 % 1000, 'a "b",\nc' if i % 11 == 0 else ("" if i % 3 else None)) for i in range(2350)]


def _cut(spark, rows, per_part=1000):
    return chunk.chunk_rows_to_parts(spark.createDataFrame(rows, "id long, ts long, note string"), [("id", "asc")], per_part)


def test_files_and_manifest(spark, tmp_path):
    path = parts.export_parts(_cut(spark, ROWS), str(tmp_path / "out"), ["id", "ts", "note"], "ts", "b1")
    names = [f"usage_events_part_00{i}.csv" for i in (1, 2, 3)]
    assert sorted(os.listdir(tmp_path / "out")) == ["metadata.json", *names]
    held = [list(csv.reader(open(tmp_path / "out" / n, newline=""))) for n in names]
    assert all(h[0] == ["id", "ts", "note"] for h in held) and [len(h) - 1 for h in held] == [1000, 1000, 350]
    cells = [[str(i), "" if ts is None else str(ts), note or ""] for i, ts, note in ROWS]
    assert [r for h in held for r in h[1:]] == cells
    times = [ts for _, ts, _ in ROWS if ts is not None]
    assert json.load(open(path)) == {
        "batch_id": "b1", "expected_file_count": 3, "expected_file_names": names, "row_counts": dict(zip(names, [1000, 1000, 350])),
        "min_event_timestamp": min(times), "max_event_timestamp": max(times),
    }
    assert sorted(r.row_count for r in parts.manifest_rows(spark, path).collect()) == [350, 1000, 1000]


def test_no_rows_no_parts(spark, tmp_path):
    path = parts.export_parts(_cut(spark, ROWS[:0]), str(tmp_path / "out"), ["id", "ts", "note"], "ts", "b1")
    assert os.listdir(tmp_path / "out") == ["metadata.json"] and json.load(open(path))["expected_file_count"] == 0


def test_failed_export_leaves_no_part(spark, tmp_path):
    bad = _cut(spark, ROWS).withColumn("note", F.when(F.col("id") == 2000, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("note")))
    with pytest.raises(Exception, match="boom"):
        parts.export_parts(bad, str(tmp_path / "out"), ["id", "ts", "note"], "ts", "b1")
    left = [f for _, _, names in os.walk(tmp_path) for f in names if f.startswith("usage_events") or f == "metadata.json"]
    assert left == []


def test_usage_export_has_all_columns(spark, tmp_path):
    from tidewater import fixtures as fx
    from tidewater.plans import jobs

    sf = "/root/testdata/sf0.001"
    curated = jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf))
    path = jobs.usage_export(curated, q_export.TODAY, "UTC", 10, str(tmp_path / "out"), "b")
    meta = json.load(open(path))
    rows = [r for n in meta["expected_file_names"] for r in csv.DictReader(open(tmp_path / "out" / n, newline=""))]
    assert list(rows[0]) == list(TRACKING_LAYOUT) and len(TRACKING_LAYOUT) == 26
    times = [int(r["timestamp"]) for r in rows]
    assert times == sorted(times) and len(times) == sum(meta["row_counts"].values()) > 10
    assert (times[0], times[-1]) == (meta["min_event_timestamp"], meta["max_event_timestamp"])


def test_offsets_on_two_levels(spark):
    counts = [(r, (r * 37) % 11) for r in range(100) if r % 7]
    got = dict(map(tuple, chunk.range_offsets(spark.createDataFrame(counts, "__range long, __n long"), 8).collect()))
    assert got == {r: sum(n for q, n in counts if q < r) for r, _ in counts}


def test_row_index_plan_holds_no_number_per_range(spark):
    df = chunk.with_row_index(spark.range(5000).withColumn("v", F.col("id") % 13), [("v", "asc"), ("id", "asc")], 50)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "element_at" not in plan
    assert [r.row_index for r in df.orderBy("v", "id").collect()] == list(range(5000))


def test_swap_survives_a_crash_between_the_renames(spark):
    rows = lambda *n: spark.createDataFrame([(i,) for i in n], "k long")
    tables.save_bucketed(rows(1), "swap_t", ["k"], 2)
    tables.swap_in(spark, rows(1, 2), "swap_t", ["k"], 2)
    assert spark.table("swap_t").count() == 2
    spark.sql("ALTER TABLE swap_t RENAME TO swap_t__old")  # as if the run had ended here
    tables.recover(spark, "swap_t")
    assert spark.table("swap_t").count() == 2
    tables.swap_in(spark, rows(1, 2, 3), "swap_t", ["k"], 2)
    assert spark.table("swap_t").count() == 3 and not spark.catalog.tableExists("swap_t__old")
    spark.sql("DROP TABLE swap_t")
