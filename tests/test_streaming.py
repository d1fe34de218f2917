"""The streaming merge resumes from its checkpoint: a second run sees only
files landed since the first, and the result equals the one-shot merge."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.operators import merge
from tidewater.plans.q_state import _prepared
from tidewater.session import scratch_path
from tidewater.sinks import keyed
from tidewater.streaming import microbatch

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _state(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _local(path):
    return path.removeprefix("file:")


def _land(spark, raw, lo: str, hi: str, path: str) -> None:
    part = raw.filter(
        (F.col("updatedAt") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("updatedAt") < F.lit(hi).cast("timestamp_ntz"))
    )
    part.coalesce(1).write.mode("append").parquet(path)


def _orders(spark, buckets=4):
    return keyed.create(fx.orders_final(spark, SF), scratch_path(spark, "stream-final"), ["id"], buckets, "updated_at")


def test_merge_stream_resumes_from_checkpoint(spark):
    raw = fx.orders_raw(spark, SF)
    src, ckpt, table = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-ckpt"), _orders(spark)

    _land(spark, raw, "1999-12-31", "2000-06-01", src)
    microbatch.merge_stream(spark, src, raw.schema, table, _prepared, checkpoint=ckpt)
    first = _state(_local(table.path))

    # Nothing new: the restarted stream commits no batch, no file changes.
    microbatch.merge_stream(spark, src, raw.schema, table, _prepared, checkpoint=ckpt)
    assert _state(_local(table.path)) == first

    _land(spark, raw, "2000-06-01", "2100-01-01", src)
    result = microbatch.merge_stream(spark, src, raw.schema, table, _prepared, checkpoint=ckpt)

    final = fx.orders_final(spark, SF)
    mark = F.lit(final.agg(F.max("updated_at")).first()[0])
    assert _rows(result) == _rows(merge.merge_upsert(final, _prepared(raw, mark), ["id"]))


def test_replay_of_a_part_merged_batch_gives_the_same_table(spark):
    """The first run of a batch ends after one bucket; its replay must not take
    the rows that are in already for the watermark."""
    raw = fx.orders_raw(spark, SF)
    src, ckpt, table = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-ckpt"), _orders(spark)
    _land(spark, raw, "1999-12-31", "2100-01-01", src)

    def dies(batch, mark):
        rows = _prepared(batch, mark)
        keyed.merge_batch(table, rows.filter(table.bucket() == 1), "in part")
        raise RuntimeError("executor and driver are gone")

    with pytest.raises(Exception, match="are gone"):
        microbatch.merge_stream(spark, src, raw.schema, table, dies, checkpoint=ckpt)
    result = microbatch.merge_stream(spark, src, raw.schema, table, _prepared, checkpoint=ckpt)
    final = fx.orders_final(spark, SF)
    mark = F.lit(final.agg(F.max("updated_at")).first()[0])
    assert _rows(result) == _rows(merge.merge_upsert(final, _prepared(raw, mark), ["id"]))


def test_untouched_buckets_are_neither_read_nor_written(spark):
    schema = "k long, g string, v int, at timestamp_ntz"
    at = "timestamp_ntz '2024-01-01 00:00:00'"
    base = spark.range(200).selectExpr("id as k", "'x' as g", "0 as v", f"{at} as at")
    table = keyed.create(base, scratch_path(spark, "keyed"), ["k", "g"], 8, "at")
    assert base.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    place = {r.k: r.b for r in base.select("k", table.bucket().alias("b")).collect()}
    assert set(place.values()) == set(range(8))
    # Files of all other buckets are spoilt: reading one would fail.
    wanted = place[7]
    other = [f for f in _state(_local(table.path)) if f"key_bucket={wanted}/" not in f]
    for f in other:
        with open(f, "wb") as out:
            out.write(b"not parquet")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.replace(crc, crc + ".old")
    before = {f: s for f, s in _state(_local(table.path)).items() if f in other}
    batch = spark.createDataFrame([(7, "x", 5)], "k int, g string, v int").withColumn("at", F.expr("timestamp_ntz '2024-02-01 00:00:00'"))
    assert keyed.merge_batch(table, batch, "b1") == [wanted]
    assert {f: s for f, s in _state(_local(table.path)).items() if f in other} == before
    got = keyed._files(spark, table).filter(F.col("key_bucket") == wanted)
    assert {r.k: r.v for r in got.collect()} == {k: 5 if k == 7 else 0 for k, b in place.items() if b == wanted}


def test_null_keys_and_replays(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "k long, v int")
    table = keyed.create(frame((1, 0), (None, 0)), scratch_path(spark, "keyed"), ["k"], 4)
    for _ in range(2):  # the second run is a replay
        assert sorted(keyed.merge_batch(table, frame((1, 1), (2, 1), (None, 1)), "b1"))[0] == -1
    keyed.merge_batch(table, frame((None, 2)), "b2")
    assert keyed.merge_batch(table, frame((1, 1)).filter("false"), "b3") == []
    assert _rows(keyed.read(spark, table)) == sorted([(1, 1), (2, 1), (None, 0), (None, 1), (None, 2)], key=repr)
    with pytest.raises(ValueError):
        keyed.merge_batch(table, frame((1, 1)), "keyed")


def test_watermark_comes_from_the_footers(spark):
    table = _orders(spark)
    micros, plan = keyed.footer_max(spark, table.path, keyed.ORDER)
    assert "PushedAggregation: [MAX(key_order)]" in plan and "ReadSchema: struct<max(key_order):bigint>" in plan
    mark = spark.range(1).select(keyed.watermark(spark, table).alias("m")).first().m
    assert mark == fx.orders_final(spark, SF).agg(F.max("updated_at")).first()[0]
    empty = keyed.create(fx.orders_final(spark, SF).filter("false"), scratch_path(spark, "keyed"), ["id"], 4, "updated_at")
    assert keyed.watermark(spark, empty) is None


def test_latest_stream_takes_files_in_any_order(spark):
    """Rows of one key arrive newest first, with ties and a null key, and the
    stream is restarted in between."""
    at = lambda d: F.expr(f"timestamp_ntz '2024-01-{d:02d} 00:00:00'")
    frame = lambda d, *rows: spark.createDataFrame(list(rows), "k long, v int").withColumn("at", at(d))
    table = keyed.create(frame(5, (1, 0), (2, 0), (9, 0)), scratch_path(spark, "keyed"), ["k"], 4, "at")
    src, ckpt = scratch_path(spark, "src"), scratch_path(spark, "ckpt")
    run = lambda: microbatch.latest_stream(spark, src, table.schema, table, lambda df: df, ["at"], checkpoint=ckpt)
    batches = [frame(20, (1, 20), (3, 20)), frame(8, (1, 8), (2, 8), (None, 8)), frame(20, (1, 19), (3, 21)), frame(4, (9, 4)), frame(12, (3, 12), (None, 12))]
    for b in batches[:2]:
        b.coalesce(1).write.mode("append").parquet(src)
    run()
    for b in batches[2:]:
        b.coalesce(1).write.mode("append").parquet(src)
    assert sorted(((r.k or -1, r.v) for r in run().collect())) == [(-1, 12), (1, 20), (2, 8), (3, 21), (9, 0)]
    assert _rows(run()) == _rows(keyed.read(spark, table))
