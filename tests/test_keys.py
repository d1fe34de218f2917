"""Bloom filters of keys, and joins that only move rows that may match."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.operators import keys, merge, replace


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_no_key_is_missed_and_few_others_pass(spark):
    target = spark.range(200_000).selectExpr("int(id) as k", "concat('g', id % 7) as g")
    batch = spark.range(0, 200_000, 500).selectExpr("id as k", "concat('g', id % 7) as g")  # another integer type
    passed = target.filter(keys.maybe_in(target, ["k", "g"], batch, 1 << 16))
    assert passed.join(batch, ["k", "g"]).count() == 400 and passed.count() < 1000


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_results_equal_the_plain_joins(spark, bits):
    """64 bits are full at once: everything passes, nothing is lost."""
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    target = frame(*[(f"k{i}", i) for i in range(300)], (None, 1), ("", 2))
    batch = frame(*[(f"k{i}", -i) for i in range(0, 600, 5)], ("k5", 7), (None, 9), ("", 8))
    assert _rows(replace.delete_by_key(target, batch, "k", bits)) == _rows(replace.delete_by_key(target, batch, "k"))
    order = [("v", "desc")]
    assert _rows(replace.replace_by_key(target, batch, "k", order, bits)) == _rows(replace.replace_by_key(target, batch, "k", order))
    assert _rows(merge.anti_insert(target, batch, ["k"], bits)) == _rows(merge.anti_insert(target, batch, ["k"]))
    none = batch.filter("false")
    assert _rows(replace.delete_by_key(target, none, "k", bits)) == _rows(target)


def test_rows_shuffled_follow_the_batch(spark):
    """Rows below the join's exchange, counted as an observed metric."""
    from pyspark.sql import Observation

    target = spark.range(100_000).selectExpr("id as k", "id as v")
    for n in (10, 1000):
        batch = spark.range(n).selectExpr("id * 90 as k")
        maybe = keys.maybe_in(target, ["k"], batch)
        seen = Observation()
        moved = target.filter(maybe).observe(seen, F.count(F.lit(1)).alias("n"))
        moved.join(keys.key_list(batch, ["k"]), "k", "left_anti").count()
        assert n <= seen.get["n"] <= 1.2 * n + 20
