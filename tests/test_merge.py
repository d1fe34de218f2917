"""MERGE family, keep-latest and replacement on hand-made rows: NULL keys,
ties, empty inputs, and the algebraic properties of each operator."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators import dedupe, merge, replace

SCHEMA = "id long, v string, ts timestamp_ntz"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def srt(items):
    return sorted(items, key=repr)


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def test_dedupe_latest_desc_nulls_last_and_ties(spark):
    df = _df(spark, [(1, "a", T1), (1, "b", T2), (1, "c", None), (2, "x", T1), (2, "y", T1), (None, "n1", T1), (None, "n2", T2)])
    out = dedupe.dedupe_latest(df, ["id"], [("ts", "desc")])
    # NULL order value loses; the tie on id 2 breaks on v DESC; NULL keys form one group.
    assert rows(out) == srt([(1, "b", T2), (2, "y", T1), (None, "n2", T2)])


def test_dedupe_requires_keys_and_order(spark):
    df = _df(spark, [(1, "a", T1)])
    with pytest.raises(ValueError):
        dedupe.dedupe_latest(df, [], [("ts", "desc")])
    with pytest.raises(ValueError):
        dedupe.dedupe_latest(df, ["id"], [])


def test_merge_upsert_null_keys(spark):
    target = _df(spark, [(1, "old", T1), (2, "keep", T1), (None, "tnull", T1)])
    source = _df(spark, [(1, "new", T2), (3, "ins", T2), (None, "snull", T2)])
    out = merge.merge_upsert(target, source, ["id"])
    # NULL keys never match: the target's NULL row stays, the source's is inserted.
    assert rows(out) == srt([(1, "new", T2), (2, "keep", T1), (3, "ins", T2), (None, "tnull", T1), (None, "snull", T2)])


def test_merge_full_sync_deletes_missing_and_empty_source_empties(spark):
    target = _df(spark, [(1, "old", T1), (2, "gone", T1), (None, "tnull", T1)])
    source = _df(spark, [(1, "new", T2)])
    out = merge.merge_upsert(target, source, ["id"], delete_not_matched_by_source=True)
    assert rows(out) == [(1, "new", T2)]
    empty = source.filter(F.lit(False))
    assert merge.merge_upsert(target, empty, ["id"], delete_not_matched_by_source=True).count() == 0


def test_merge_is_idempotent(spark):
    target = _df(spark, [(1, "old", T1), (2, "keep", T1)])
    source = _df(spark, [(1, "new", T2), (3, "ins", T2)])
    once = merge.merge_upsert(target, source, ["id"])
    twice = merge.merge_upsert(once, source, ["id"])
    assert rows(once) == rows(twice)


def test_merge_match_and_counts(spark):
    target = _df(spark, [(1, "a", T1), (2, "b", T1)])
    source = _df(spark, [(2, "c", T2), (3, "d", T2), (None, "e", T2)])
    counts = dict(merge.merge_counts(merge.merge_match(target, source, ["id"])).collect())
    assert counts == {"matched": 1, "not_matched": 2, "not_matched_by_source": 1}


def test_merge_rejects_missing_columns(spark):
    target = _df(spark, [(1, "a", T1)])
    with pytest.raises(ValueError):
        merge.merge_upsert(target, target.drop("v"), ["id"])


def test_anti_insert_keeps_duplicate_new_keys(spark):
    target = _df(spark, [(1, "a", T1)])
    source = _df(spark, [(1, "dup-of-existing", T2), (5, "x", T2), (5, "y", T2)])
    out = merge.anti_insert(target, source, ["id"])
    # The insert-only merge does not dedupe inside the batch: both 5s land.
    assert rows(out) == srt([(1, "a", T1), (5, "x", T2), (5, "y", T2)])
    again = merge.anti_insert(out, source, ["id"])
    assert rows(again) == rows(out)


def test_replace_by_key_and_null_target_key(spark):
    hist = _df(spark, [(1, "h1", T1), (2, "h2", T1), (None, "hn", T1)])
    raw = _df(spark, [(2, "r2a", T2), (2, "r2b", T3), (None, "rn", T3), (4, "r4", T1)])
    out = replace.replace_by_key(hist, raw, "id", [("ts", "desc")])
    assert rows(out) == srt([(1, "h1", T1), (None, "hn", T1), (2, "r2b", T3), (4, "r4", T1)])
    twice = replace.replace_by_key(out, raw, "id", [("ts", "desc")])
    assert rows(twice) == rows(out)


def test_replace_local_day_empty_rebuild_still_deletes(spark):
    df = spark.createDataFrame(
        [(1, 1704866558445), (2, 1704700000000), (3, None)], "id long, timestamp long"
    )  # 1: 2024-01-10 00:02 Chicago; 2: 2024-01-08; 3: NULL
    empty = df.filter(F.lit(False))
    out = replace.replace_local_day(df, empty, "timestamp", "2024-01-10", "2024-01-11", "America/Chicago")
    assert sorted(r.id for r in out.collect()) == [2, 3]


def test_replace_date_range_inclusive_and_null_survives(spark):
    target = _df(spark, [(1, "a", T1), (2, "b", T2), (3, "c", None), (4, "d", T3)])
    new = _df(spark, [(9, "n", T2)])
    out = replace.replace_date_range(target, new, "ts", "2024-01-02", "2024-01-03")
    assert rows(out) == srt([(1, "a", T1), (3, "c", None), (9, "n", T2)])


def test_replicate_run_windows(spark):
    from tidewater import fixtures as fx
    from tidewater.plans import jobs
    from tidewater.plans.configs import TableConfig

    sf = "/root/testdata/sf0.001"
    cfg = TableConfig("o", "orders", "orders_final", ("id",), ("id",), (("updated_at", "DESC"), ("_loaded_at", "DESC")),
                      "updatedAt", "updated_at")
    raw, final = fx.orders_raw(spark, sf), fx.orders_final(spark, sf)
    run_ts, now = datetime(2024, 2, 1, 5), datetime(2024, 2, 1, 5)
    from_watermark = jobs.replicate_run(raw, final, cfg, run_ts, now)
    one_shot = jobs.replicate_table(raw, final, cfg, run_ts)
    assert rows(from_watermark) == rows(one_shot)
    # A backfill window entirely behind the watermark changes nothing (late rows drop) ...
    everything = spark.read.parquet(sf + "/orders.parquet").selectExpr(
        "o_custkey AS id", "o_orderkey AS orderNo", "o_orderstatus AS status",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total", "o_orderdate AS updatedAt")
    back = jobs.replicate_run(everything, final, cfg, run_ts, now, explicit_start=datetime(1990, 1, 1),
                              explicit_end=datetime(1999, 6, 30))
    assert back.filter("_loaded_at IS NOT NULL").count() == 0
    # ... unless late rows are accepted.
    accepted = jobs.replicate_run(everything, final, cfg, run_ts, now, explicit_start=datetime(1990, 1, 1),
                                  explicit_end=datetime(1999, 6, 30), late_policy="accept")
    assert accepted.filter("_loaded_at IS NOT NULL").count() > 0


def test_replace_date_range_text_dates(spark):
    target = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None), (4, "garbage")], "id long, d string")
    new = spark.createDataFrame([(9, "2024-01-02")], "id long, d string")
    out = replace.replace_date_range(target, new, "d", "2024-01-02", "2024-01-03")
    assert sorted(r.id for r in out.collect()) == [1, 3, 4, 9]


def test_job_replicate_orders_takes_every_row_past_the_watermark(spark, tmp_path):
    from tidewater.plans import registry

    registry.load_all()
    orders = [(1, 7, "O", 10.0, datetime(1999, 5, 1)), (2, 7, "O", 20.0, datetime(2000, 1, 10)),
              (3, 8, "F", 30.0, datetime(2001, 7, 1)), (4, 9, "P", 40.0, datetime(2000, 6, 1))]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    out = registry.QUERIES["job_replicate_orders"](spark, str(tmp_path))
    got = {r["id"]: (r["order_no"], r["_loaded_at"] is not None) for r in out.collect()}
    assert got == {7: (2, True), 8: (3, True), 9: (4, True)}
