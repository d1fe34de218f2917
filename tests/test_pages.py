"""Paged payloads without a declared schema."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from tidewater.plans import configs, jobs
from tidewater.sources import pages


def _pages(spark, *texts, day=None):
    if day is None:
        return spark.createDataFrame([(t,) for t in texts], "value string")
    return spark.createDataFrame([(t, day) for t in texts], "value string, day date")


def _page(*rows):
    return json.dumps({"data": list(rows), "paging": {}})


def test_no_value_is_lost(spark):
    lines = _pages(spark, _page({"ad_id": "12", "spend": "1.5", "impressions": "3", "clicks": 7}, {"ad_id": 13, "spend": 2, "flag": True}), " ")
    known = T.StructType.fromDDL("ad_id bigint, spend double, impressions double")
    out = pages.flatten_paged_payload(lines, known)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("ad_id", "bigint"), ("spend", "double"), ("impressions", "double"), ("clicks", "bigint"), ("flag", "boolean"),
    ]
    assert sorted(map(tuple, out.collect())) == [(12, 1.5, 3.0, 7, None), (13, 2.0, None, None, True)]


def test_columns_widen_and_nested_values_stay_whole(spark):
    rows = [{"a": 1, "b": 1, "c": [1, {"x": None}], "id": "007", "n": None}, {"a": "x", "b": 2.5, "c": 3, "id": "12", "big": 2**70, "odd name": "y"}]
    got = {r["id"]: r.asDict() for r in pages.flatten_paged_payload(_pages(spark, _page(*rows))).collect()}
    assert got["007"] == {"a": "1", "b": 1.0, "c": '[1,{"x":null}]', "id": "007", "n": None, "big": None, "odd name": None}
    assert got["12"] == {"a": "x", "b": 2.5, "c": "3", "id": "12", "n": None, "big": str(2**70), "odd name": "y"}


@pytest.mark.parametrize(
    "kinds, known, want",
    [
        (dict(texts=2, integer_texts=2, number_texts=2), T.LongType(), "bigint"),
        (dict(texts=2, integer_texts=1, number_texts=2), T.LongType(), "double"),
        (dict(texts=2, integer_texts=1, number_texts=1), T.LongType(), "string"),
        (dict(numbers=1, integers=1), T.LongType(), "double"),
        (dict(booleans=1), T.DoubleType(), "string"),
        (dict(booleans=1), T.BooleanType(), "boolean"),
        (dict(), T.LongType(), "bigint"),
        (dict(), None, "string"),
        (dict(booleans=1, integers=1), None, "string"),
        (dict(nested=1), None, "string"),
    ],
)
def test_column_type(kinds, known, want):
    names = ("booleans", "integers", "numbers", "texts", "integer_texts", "number_texts", "nested")
    assert pages.column_type(T.Row(**{n: kinds.get(n, 0) for n in names}), known).simpleString() == want


BROKEN = ['{"data":[{"a":1},{"a', "[1]", '{"error":{"code":1}}', '{"data":null}', '{"data":[{"a":1},2]}']


def test_broken_pages_are_set_aside(spark):
    got = pages.land_rows(_pages(spark, _page({"a": 5}), '{"paging":{}}', *BROKEN), on_broken="quarantine")
    reasons = ["not JSON", "not an object", "error response", "data is not a list", "a row is not an object"]
    assert sorted(map(tuple, got.broken.collect())) == sorted(zip(BROKEN, reasons))
    assert got.rows.count() == 1


@pytest.mark.parametrize("page", BROKEN)
def test_broken_pages_fail_the_job(spark, page):
    with pytest.raises(Exception, match="page can't be read"):
        pages.land_rows(_pages(spark, _page({"a": 5}), page))


def test_insights_grow_the_table(spark):
    run = lambda lines, table, day, marks: jobs.ads_insights(lines, table, day, day, "s", datetime(2024, 1, 9), marks)
    first = _pages(spark, _page({"date_start": "2024-01-05", "ad_id": 1, "day": "x"}), day=date(2024, 1, 5))
    table, marks = run(first, None, "2024-01-05", None)
    second = _pages(spark, _page({"date_start": "2024-01-06", "ad_id": "2", "reach": 9}), day=date(2024, 1, 6))
    table, marks = run(first.union(second), table, "2024-01-06", marks)
    again = _pages(spark, _page({"date_start": "2024-01-06", "ad_id": "b", "reach": 8.5}), day=date(2024, 1, 6))
    table, marks = run(again, table, "2024-01-06", marks)
    got = sorted((r.date_start, r.ad_id, r.reach, r.day, str(r._window_date)) for r in table.collect())
    assert got == [("2024-01-05", "1", None, "x", "2024-01-05"), ("2024-01-06", "b", 8.5, None, "2024-01-06")]
    table, marks = run(again.filter("false"), table, "2024-01-06", marks)
    assert [r.ad_id for r in table.collect()] == ["1"] and marks.first().value == date(2024, 1, 6)


def test_pages_of_a_window_are_pruned(spark, tmp_path):
    rows = [(_page({"date_start": f"2024-01-{d:02d}", "ad_id": d}), date(2024, 1, d)) for d in range(1, 29)]
    path = pages.land_pages(spark.createDataFrame(rows, "page string, day date"), str(tmp_path / "p"))
    plan = spark.read.parquet(path).filter("day between date '2024-01-05' and date '2024-01-06'")
    assert "GreaterThanOrEqual(day,2024-01-05), LessThanOrEqual(day,2024-01-06)" in plan._jdf.queryExecution().toString()


def test_catalogue():
    assert len(configs.ADS_BY_NAME) == 10 and sum(s.stream_type == "insights" for s in configs.ADS_STREAMS) == 6
    with pytest.raises(ValueError):
        configs.AdsStream("x", "insights")


def _json(spark, tmp_path, *lines, **kwargs):
    (tmp_path / "in.json").write_text("\n".join(lines))
    return pages.infer_json(spark, str(tmp_path / "in.json"), **kwargs)


def test_one_pass_inference(spark, tmp_path):
    out = _json(
        spark, tmp_path, '{"a":1,"b":{"c":[1,2],"d":"x"},"e":1,"f":true,"n":null}', "",
        '{"a":2.5,"b":{"c":[3],"z":null},"e":"t","g h":[{"i":1},{"i":2}]}', '{"e":{"k":1}}',
    )
    assert {f.name: f.dataType.simpleString() for f in out.schema.fields} == {
        "a": "double", "b": "struct<c:array<bigint>,d:string,z:string>", "e": "string", "f": "boolean", "n": "string",
        "g h": "array<struct<i:bigint>>",
    }
    got = sorted((r.asDict(recursive=True) for r in out.collect()), key=lambda r: r["e"])
    assert [(r["a"], r["e"], r["f"]) for r in got] == [(1.0, "1", True), (2.5, "t", None), (None, '{"k":1}', None)]
    assert got[0]["b"] == {"c": [1, 2], "d": "x", "z": None} and got[1]["g h"] == [{"i": 1}, {"i": 2}]


def test_one_pass_inference_of_broken_lines(spark, tmp_path):
    with pytest.raises(Exception, match="no JSON object"):
        _json(spark, tmp_path, '{"a":1}', '{"a')
    assert [tuple(r) for r in _json(spark, tmp_path, '{"a":1}', '{"a', "[1]", on_broken="skip").collect()] == [(1,)]
    assert _json(spark, tmp_path, "").columns == []


def test_values_are_looked_at_once(spark):
    rows = pages.land_rows(_pages(spark, _page({"a": "1", "b": [1]}))).rows
    # Each kind, and each text, comes from one expression of the plan, not from one per count or test.
    kinds = pages.field_kinds(rows, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert kinds.count("SchemaOfVariant.schemaOfVariant(") == 1 and kinds.count("try_variant_get(") == 1


def test_only_texts_of_number_columns_are_tried_as_numbers(spark):
    rows = pages.land_rows(_pages(spark, _page({"a": "1", "b": "2"}, {"a": "1.5"}, {"a": None, "b": "x"}))).rows
    counts = lambda *names: {r["name"]: tuple(r[c] for c in ("texts", "integer_texts", "number_texts")) for r in pages.field_kinds(rows, *names).collect()}
    assert counts() == {"a": (2, 1, 2), "b": (2, 1, 1)}
    assert counts(["a"]) == {"a": (2, 1, 2), "b": (2, 0, 0)} and counts([]) == {"a": (2, 0, 0), "b": (2, 0, 0)}
