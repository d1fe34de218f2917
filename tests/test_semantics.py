"""Rules on hand-made inputs: contracts, time windows (DST), NPS parsing,
CSV declared schemas, NDJSON archives, schema evolution, chunking."""

from __future__ import annotations

import gzip
import io
import io
import os
import tempfile
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import contract as C
from tidewater.functions import naming
from tidewater.functions import semistructured as J
from tidewater.functions import time as TM
from tidewater.operators import chunk, filters, project, records, schema
from tidewater.plans import windows
from tidewater.sources import csv_declared as CSV
from tidewater.sources import ndjson


# --- naming and windows -------------------------------------------------------


def test_snake_case():
    assert naming.to_snake_case("updatedAt") == "updated_at"
    assert naming.to_snake_case("autoBreakEvenTriggeredAt") == "auto_break_even_triggered_at"
    assert naming.to_snake_case("HTTPServer") == "http_server"
    assert naming.column_key("updated_at") == naming.column_key("updatedAt")


def test_duplicate_snake_names_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "userId long, user_id long")
    with pytest.raises(ValueError):
        project.project_snake_case(df)
    with pytest.raises(ValueError):
        project.project_snake_case(df.drop("user_id"), required=["updated_at"])


def test_dst_days_are_23_and_25_hours():
    lo, hi = TM.local_day_bounds_utc("2024-03-10", "2024-03-11", "America/Chicago")
    assert (hi - lo).total_seconds() == 23 * 3600
    lo, hi = TM.local_day_bounds_utc("2024-11-03", "2024-11-04", "America/Chicago")
    assert (hi - lo).total_seconds() == 25 * 3600


def test_weekly_window_tuesday_counts():
    assert windows.weekly_window(date(2024, 1, 23)) == (date(2024, 1, 16), date(2024, 1, 23))  # Tuesday
    assert windows.weekly_window(date(2024, 1, 22)) == (date(2024, 1, 9), date(2024, 1, 16))  # Monday


def test_replication_windows():
    now = datetime(2024, 1, 11, 10, 0)
    w = windows.previous_local_day(now, "America/Lima")
    assert (w.start, w.end) == (datetime(2024, 1, 10, 5), datetime(2024, 1, 11, 5))
    w = windows.resolve_replication_window(now, datetime(2024, 1, 1), lookback_seconds=60)
    assert (w.start, w.end) == (datetime(2023, 12, 31, 23, 59), None)
    w = windows.resolve_replication_window(now, datetime(2024, 1, 1), explicit_start=datetime(2023, 6, 1), lookback_seconds=60)
    assert w.start == datetime(2023, 6, 1)
    w = windows.resolve_replication_window(now, None, fixed_minutes=30)
    assert (w.start, w.end) == (datetime(2024, 1, 11, 9, 30), now)


def test_bookmark_window_rules():
    w = windows.bookmark_window(date(2024, 1, 20), date(2024, 1, 19), 2)
    assert (w.start, w.end) == (date(2024, 1, 19), date(2024, 1, 20))
    w = windows.bookmark_window(date(2024, 1, 20), date(2024, 1, 19), 2, full_refresh=True)
    assert w.start == date(2024, 1, 18)
    w = windows.bookmark_window(date(2024, 1, 20), None, 2, explicit_start=date(2024, 1, 25))
    assert w.inverted


def test_local_day_filter_pushes_both_bounds(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = filters.filter_local_day(df, "ts", "2024-01-10", "2024-01-11", "America/Chicago")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-10T06:00)" in plan and "LessThan(ts,2024-01-11T06:00)" in plan


# --- contract -------------------------------------------------------------------


def _tracking_row(name, **kw):
    cols = ["name"] + [r.flag for r in C.TRACKING_CONTRACT.rules] + sorted(
        {a for r in C.TRACKING_CONTRACT.rules for a in r.owned}
    )
    base = {c: None for c in cols}
    base["name"] = name
    base.update(kw)
    return base, cols


def test_contract_rules(spark):
    cases = [
        (dict(name="replay_activated", is_replay_activated=1), True),
        (dict(name="replay_activated", is_replay_activated=2), False),  # sum test, flag must be 1
        (dict(name="quick_buy_sell", is_quick_buy_sell=1), False),  # required attribute missing
        (dict(name="quick_buy_sell", is_quick_buy_sell=1, quick_buy_sell_type="buy"), True),
        (dict(name="quick_buy_sell", is_quick_buy_sell=1, quick_buy_sell_type="buy", order_tag_count="1"), False),
        (dict(name="order_placed", is_order_placed=1, order_tag_count="1"), True),
        (dict(name="order_placed", is_order_placed=1, is_replay_activated=1), False),  # two flags
        (dict(name="app_error", is_replay_activated=1), False),
    ]
    data, cols = [], None
    for kw, _ in cases:
        row, cols = _tracking_row(**kw)
        data.append(tuple(row[c] for c in cols))
    ddl = ", ".join(f"{c} {'int' if c.startswith('is_') else 'string'}" for c in cols)
    df = spark.createDataFrame(data, ddl).withColumn("__i", F.monotonically_increasing_id())
    got = [r["ok"] for r in df.select(C.full_contract(C.TRACKING_CONTRACT).alias("ok"), "__i").orderBy("__i").collect()]
    assert got == [expected for _, expected in cases]


# --- NPS rules --------------------------------------------------------------------


def _score(spark, responses_json: str):
    line = '{"attributes":{"interactionData":{"surveyResponses":' + responses_json + "}}}"
    df = spark.createDataFrame([(line,)], "line string")
    rec = J.parse_record("line")
    return df.selectExpr(f"{J.extract_nps_score(J.json_parse_or_keep(J.field(rec, '$.attributes')))} AS s").first()["s"]


@pytest.mark.parametrize(
    "responses, expected",
    [
        ('[{"type":"nps_score","value":9}]', 9),
        ('[{"type":"nps_score","value":8.9}]', 8),
        ('[{"type":"nps_score","value":-3.7}]', -3),
        ('[{"type":"nps_score","value":" 7 "}]', 7),
        ('[{"type":"nps_score","value":"1e1"}]', 10),
        ('[{"type":"nps_score","value":"n/a"}]', None),
        ('[{"type":"nps_score","value":"inf"}]', None),
        ('[{"type":"nps_score","value":true},{"type":"nps_score","value":5}]', None),
        ('[{"type":"nps_score","value":null},{"type":"nps_score","value":6}]', 6),
        ('[{"type":"nps_score","value":[1]},{"type":"nps_score","value":4}]', 4),
        ('[{"type":"text","value":"9"}]', None),
        ("[]", None),
        ('{"not":"a list"}', None),
        ('[{"type":"nps_score","value":42}]', 42),  # no range check
    ],
)
def test_extract_nps_score(spark, responses, expected):
    assert _score(spark, responses) == expected


def test_stringify_and_attributes_in_string(spark):
    lines = [
        '{"id":null,"name":"appcues:v2:step_interaction","timestamp":"2024-01-01T00:00:00Z",'
        '"attributes":"{\\"experienceType\\":\\"nps\\",\\"interactionData\\":{\\"surveyResponses\\":[{\\"type\\":\\"nps_score\\",\\"value\\":3}]}}"}',
        '{"id":"","name":"appcues:v2:step_interaction","timestamp":"","attributes":{"experienceName":"My NPS",'
        '"interactionData":{"surveyResponses":[{"type":"nps_score","value":3}]}}}',
        '{"id":7,"name":"appcues:v2:step_interaction","timestamp":"2024-01-01T00:00:00Z","attributes":{"experienceName":"My nps",'
        '"interactionData":{"surveyResponses":[{"type":"nps_score","value":3}]}},"identity":{"b":1,"a":2}}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    out = records.nps_rows(df, date(2024, 1, 2), datetime(2024, 1, 2, 6)).orderBy("event_id").collect()
    # Row 2 drops: empty timestamp is falsy. JSON-in-string attributes parse.
    assert [r.event_id for r in out] == ["7", "None"]
    assert out[0].identity == '{"b":1,"a":2}'  # key order as written
    assert out[1].attributes.startswith('{"experienceType":"nps"')
    assert out[1].event_timestamp == datetime(2024, 1, 1)


# --- CSV declared schema ------------------------------------------------------------


def _write(path, text, mode="w"):
    with open(path, mode, newline="") as fh:
        fh.write(text)


def test_schema_file_synonyms_and_errors():
    fields = CSV.parse_schema_rows(
        ["Column_Name", "Data_Type", "Nullable"],
        [{"Column_Name": "a", "Data_Type": "int", "Nullable": "no"}, {"Column_Name": " ", "Data_Type": "x"},
         {"Column_Name": "b", "Data_Type": "mystery", "Nullable": "yes"}],
    )
    assert [(f.name, f.type_name, f.mode) for f in fields] == [("a", "INT64", "REQUIRED"), ("b", "STRING", "NULLABLE")]
    with pytest.raises(ValueError):
        CSV.parse_schema_rows(["foo"], [{"foo": "a"}])


def test_declared_csv_edge_cases(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    _write(os.path.join(d, "schema.csv"), "﻿name,type\nid,INTEGER\nts,TIMESTAMP\nlabel,STRING\nmissing,STRING\n")
    _write(
        os.path.join(d, "predictions_part_001.csv"),
        '﻿id,ts,label,extra\r\n1,2024-01-02T03:04:05,"",x\r\n2,2024-01-02 03:04:05,b,x\r\n3,,c\r\n',
    )
    fields = CSV.read_schema_file(spark, os.path.join(d, "schema.csv"))
    out = CSV.read_declared_csv(spark, os.path.join(d, "predictions_part_*.csv"), fields, "b1", datetime(2024, 1, 3))
    got = sorted(tuple(r) for r in out.select("id", "ts", "label", "missing", "batch_id").collect())
    ts = datetime(2024, 1, 2, 3, 4, 5)
    assert got == [(1, ts, "", "", "b1"), (2, ts, "b", "", "b1"), (3, None, "c", "", "b1")]
    assert {r.source_file_name for r in out.collect()} == {"predictions_part_001.csv"}


def test_declared_csv_maps_each_file_by_its_own_header(spark):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    _write(os.path.join(d, "predictions_part_001.csv"), 'id,name,ok\n1,"He said ""hi"", ok",yes\n')
    _write(os.path.join(d, "predictions_part_002.csv"), "ok,extra,name,id\nF,x,b,2\n,y,c,3\n")
    _write(os.path.join(d, "predictions_part 3.csv"), "")
    fields = [CSV.DeclaredField("id", "INT64", "REQUIRED"), CSV.DeclaredField("name", "STRING"), CSV.DeclaredField("ok", "BOOL")]
    out = CSV.read_declared_csv(spark, os.path.join(d, "predictions_part*.csv"), fields, "b1")
    got = sorted(tuple(r) for r in out.select("id", "name", "ok", "source_file_name").collect())
    assert got == [
        (1, 'He said "hi", ok', True, "predictions_part_001.csv"),
        (2, "b", False, "predictions_part_002.csv"),
        (3, "c", None, "predictions_part_002.csv"),
    ]
    assert CSV.read_declared_csv(spark, os.path.join(d, "predictions_part 3.csv"), fields, "b1").collect() == []


@pytest.mark.parametrize("cells", ["x,1.5,yes", "1,abc,yes", "1,1.5,maybe", ",1.5,yes"])
def test_declared_csv_bad_cells_fail(spark, cells):
    d = tempfile.mkdtemp(prefix="tw-csv-")
    _write(os.path.join(d, "a.csv"), f"id,score,ok\n{cells}\n")
    fields = [CSV.DeclaredField("id", "INT64", "REQUIRED"), CSV.DeclaredField("score", "FLOAT64"), CSV.DeclaredField("ok", "BOOL")]
    with pytest.raises(Exception, match="column (id|score|ok)"):
        CSV.read_declared_csv(spark, os.path.join(d, "a.csv"), fields).collect()


def test_declared_csv_fractional_seconds_fail(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123",)], "s string")
    with pytest.raises(Exception):
        df.select(CSV.normalize_csv_timestamp(F.col("s"))).collect()


# --- NDJSON archives ----------------------------------------------------------------


def test_ndjson_archives_and_junk(spark):
    d = tempfile.mkdtemp(prefix="tw-ndjson-")
    body = b'{"a":1}\n\n{broken\n[1,2]\n{"a":2}\n\xff{"a":3}\n'
    with open(os.path.join(d, "export_no_ext"), "wb") as fh:
        fh.write(gzip.compress(body))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("inner.json", body)
    with open(os.path.join(d, "export.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    with open(os.path.join(d, "plain.json"), "wb") as fh:
        fh.write(body)
    out = ndjson.scan_ndjson_export(spark, d, archives=True)
    got = sorted(r.line for r in out.collect())
    assert got == sorted(['{"a":1}', '{"a":2}'] * 3)  # the line with an invalid byte fails to parse


def test_ndjson_archives_are_found_by_content(spark):
    d = tempfile.mkdtemp(prefix="tw-ndjson-")
    body = lambda n: f'{{"n":{n},"t":"x\u2028y"}}\n'.encode() * 2
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("inner.json", body(1))
    held = {"no_ext": gzip.compress(body(0)), "x.zip": buf.getvalue(), "x.json.gz": gzip.compress(body(2)), "x.json": body(3), "one": b"P", "none": b""}
    for name, content in held.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(content)
    out = ndjson.scan_ndjson_export(spark, d)
    got = sorted(r.line for r in out.collect())
    assert got == [f'{{"n":{n},"t":"x\u2028y"}}' for n in range(4) for _ in range(2)]


# --- schema evolution ---------------------------------------------------------------


def test_reconcile_schema_add_drop_widen_skip(spark):
    df = spark.createDataFrame([(1, "x", 5)], "a int, b string, gone int")
    desired = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("c", T.DateType())])
    out = schema.reconcile_schema(df, desired)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [
        ("a", T.LongType()), ("b", T.StringType()), ("c", T.DateType())
    ]
    grown = schema.evolve_schema_additive(df, desired)
    assert grown.columns == ["a", "b", "gone", "c"]


def test_coerce_bool_null_to_zero(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    out = project.coerce_to_existing_type(df, {"f": "BOOL"}, {"f": "INT64"})
    assert sorted(r.f for r in out.collect()) == [0, 0, 1]


# --- chunking -----------------------------------------------------------------------


@pytest.mark.parametrize("n_rows, per_part", [(2350, 1000), (1000, 1000), (1, 7), (0, 5)])
def test_chunk_parts_exact(spark, n_rows, per_part):
    df = spark.range(n_rows).withColumn("v", F.col("id") * 3 % 17)
    parts = chunk.chunk_rows_to_parts(df, [("v", "asc"), ("id", "asc")], per_part, num_partitions=4)
    sizes = dict(parts.groupBy("part_no").count().collect())
    expected = {i + 1: min(per_part, n_rows - i * per_part) for i in range(-(-n_rows // per_part))}
    assert sizes == expected
    idx = sorted(r.row_index for r in parts.collect())
    assert idx == list(range(n_rows))
    ordered = [(r.v, r.id) for r in parts.orderBy("row_index").collect()]
    assert ordered == sorted(ordered)


def test_canonical_text_naive_and_aware(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120000))], "a timestamp_ntz, b timestamp_ntz"
    ).selectExpr("a", "CAST(b AS TIMESTAMP) AS b")
    row = project.canonicalize_values(df).first()
    assert row.a == "2024-01-02 03:04:05"
    assert row.b == "2024-01-02T03:04:05.120000+00:00"


def test_week_filter_pushes_both_units(spark):
    from tidewater.plans import q_export

    df = q_export.week_rows(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Both unit branches reach the Parquet reader as one pushed disjunction.
    assert "PushedFilters: [Or(And(And(GreaterThanOrEqual(timestamp,1000000000000)" in plan


def test_nps_run_inverted_window_sets_bookmark_and_loads_nothing(spark):
    from tidewater.plans import jobs

    bookmarks = spark.createDataFrame([("nps", "event_date", date(2024, 1, 19))], "stream string, field string, value date")
    hist, marks = jobs.nps_run(
        spark, "/nonexistent", None, bookmarks, date(2024, 1, 20), datetime(2024, 1, 20, 6),
        explicit_start=date(2024, 1, 25),
    )
    assert hist.count() == 0
    assert marks.filter("stream = 'nps'").first().value == date(2024, 1, 20)


def test_ads_insights_inverted_window_changes_nothing(spark):
    from tidewater.plans import jobs

    existing = spark.createDataFrame([(1, "2024-01-01")], "ad_id long, date_start string")
    pages = spark.createDataFrame([('{"data":[]}', date(2024, 1, 5))], "value string, day date")
    table, marks = jobs.ads_insights(pages, existing, "2024-01-05", "2024-01-04", "s", datetime(2024, 1, 6), None)
    assert table.count() == 1 and marks.count() == 0


def test_nps_run_loads_history_and_moves_bookmark(spark):
    import __spark_entry__ as E
    from tidewater.plans import jobs
    from tidewater.plans.q_semistructured import INGESTED_AT, RUN_DATE, land_feed

    sf = "/root/testdata/sf0.001"
    path = land_feed(spark, sf)
    bookmarks = spark.createDataFrame([], "stream string, field string, value date")
    hist, marks = jobs.nps_run(spark, path, None, bookmarks, RUN_DATE, INGESTED_AT)
    expected = E.queries()["dedupe_latest_nps"](spark, sf)
    assert sorted(map(tuple, hist.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert marks.first().value == RUN_DATE


def test_missing_final_table_means_full_read(spark):
    from tidewater.sources import scans

    missing = scans.read_if_exists(spark, os.path.join(tempfile.mkdtemp(), "nope"))
    assert missing is None and scans.max_watermark(missing, "updated_at") is None
    src = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = scans.scan_above_watermark(src, "o_orderdate", missing, "updated_at")
    assert out.count() == src.count()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_week_reads_back_in_both_formats(spark, fmt):
    from tidewater.plans import q_export
    from tidewater.sinks import files

    rows = q_export.week_rows(spark, "/root/testdata/sf0.001")
    out = files.export_week(rows, tempfile.mkdtemp(prefix="tw-week-"), "2024-01-16", "2024-01-23", fmt=fmt)
    assert "week_start=2024-01-16" in out and "week_end=2024-01-23" in out
    reader = spark.read.schema(q_export.USAGE_SCHEMA)
    back = reader.option("header", True).csv(out) if fmt == "csv" else reader.parquet(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_part_names_are_not_cut_past_999(spark):
    from tidewater.operators.chunk import chunk_rows_to_parts, export_manifest

    rows = spark.range(12_030).selectExpr("id", "id * 10 as ts")
    parts = chunk_rows_to_parts(rows, ["id"], 10)
    got = export_manifest(parts, "ts", "b").collect()
    assert len({r.file_name for r in got}) == len(got) == 1203 and sum(r.row_count for r in got) == 12_030
    assert {"usage_events_part_001.csv", "usage_events_part_1000.csv", "usage_events_part_1203.csv"} <= {r.file_name for r in got}


def test_snake_case_rule():
    from tidewater.functions import naming

    for name, want in (
        ("ABCDEf", "abcd_ef"), ("aBC", "a_bc"), ("v2API", "v2_api"), ("A1b", "a1b"), ("_Abc", "__abc"), ("AaBbCc", "aa_bb_cc"),
        ("already_snake", "already_snake"), ("", ""), ("ABC1d", "abc1d"), ("userID", "user_id"), ("X", "x"),
    ):
        assert naming.to_snake_case(name) == want, name
    assert naming.column_key("Updated-At_2é") == "updatedat2"


def test_archive_lines_split_at_newlines_only():
    import gzip

    from tidewater.sources.ndjson import decoded_lines

    data = '{"a":"x\u2028y z"}\r\n{"b":1}\n\n{"c":2}'.encode()
    for content in (data, gzip.compress(data)):
        assert [x for x in decoded_lines(io.BytesIO(content)) if x] == ['{"a":"x\u2028y z"}', '{"b":1}', '{"c":2}']


def test_latest_batch_matches_the_glob_exactly(spark, tmp_path):
    from tidewater.sources.csv_declared import latest_batch

    for batch, name in (("a", "predictions_part_1.csv"), ("b", "predictionsXpartY1.csv")):
        (tmp_path / batch).mkdir()
        for f in (name, "metadata.json", "schema.csv"):
            (tmp_path / batch / f).write_text("x")
    assert latest_batch(spark, str(tmp_path)).endswith("/a")


def test_declared_csv_quotes_and_booleans(spark, tmp_path):
    from tidewater.sources.csv_declared import DeclaredField, read_declared_csv

    (tmp_path / "x.csv").write_text('name,ok\n"He said ""hi"", ok",yes\nb,t\nc,no\n')
    fields = [DeclaredField("name", "STRING", "NULLABLE"), DeclaredField("ok", "BOOL", "NULLABLE")]
    got = sorted(tuple(r) for r in read_declared_csv(spark, str(tmp_path / "x.csv"), fields).collect())
    assert got == [('He said "hi", ok', True), ("b", True), ("c", False)]


def test_week_export_keeps_spaces_and_quotes(spark, tmp_path):
    import csv
    import glob
    import gzip

    from tidewater.sinks import files

    rows = [("  pad  ", 'say "x", y'), ("plain", "z")]
    out = files.export_week(spark.createDataFrame(rows, "a string, b string").coalesce(1), str(tmp_path), "s", "e")
    with gzip.open(glob.glob(out + "/*.csv.gz")[0], "rt", newline="") as f:
        assert sorted(map(tuple, list(csv.reader(f))[1:])) == sorted(rows)


def test_hot_key_is_split_in_key_deletes_and_insert_only_merges(spark):
    from pyspark.sql import functions as F

    from tidewater.operators import merge, replace

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 900_000, 1, 8).select(F.expr("if(id % 3 = 0, -1, id)").alias("k"), F.hash("id").alias("v"))
        few = spark.range(0, 300_000, 1, 8).select((F.col("id") * 5).alias("k"), F.hash("id").alias("v"))
        for got in (replace.delete_by_key(hot, few, "k"), merge.anti_insert(few, hot, ["k"])):
            out = got.agg(F.count("*").alias("n"), F.sum("v").alias("s"))
            assert out.collect()[0]["n"] > 300_000
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
