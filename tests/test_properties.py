"""Algebraic properties on generated data, and a hot key holding a third of
all rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import chunk, dedupe, joins, merge, replace

SCHEMA = "id long, v string, ts timestamp_ntz"
T0 = datetime(2024, 1, 1)

row = st.tuples(
    st.one_of(st.none(), st.integers(0, 6)),
    st.text(alphabet="abc", min_size=1, max_size=2),
    st.integers(0, 5).map(lambda d: T0 + timedelta(days=d)),
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_merge_properties(spark, target_rows, source_rows):
    target = dedupe.dedupe_latest(spark.createDataFrame(target_rows, SCHEMA), ["id"], [("ts", "desc")])
    target = target.filter(F.col("id").isNotNull()).unionByName(
        spark.createDataFrame([r for r in target_rows if r[0] is None], SCHEMA)
    )
    source = dedupe.dedupe_latest(spark.createDataFrame(source_rows, SCHEMA), ["id"], [("ts", "desc")])
    once = merge.merge_upsert(target, source, ["id"])
    # Idempotent for non-NULL keys; each NULL-key source row is re-inserted per run.
    twice = merge.merge_upsert(once, source.filter(F.col("id").isNotNull()), ["id"])
    assert _rows(once) == _rows(twice)
    # Full sync result = the deduplicated source.
    synced = merge.merge_upsert(target, source, ["id"], delete_not_matched_by_source=True)
    assert _rows(synced) == _rows(source)
    # Row count = target + inserted keys (+ NULL-key source rows).
    t_keys = {r[0] for r in target.collect() if r[0] is not None}
    s = source.collect()
    inserted = sum(1 for r in s if r[0] is None or r[0] not in t_keys)
    assert once.count() == target.count() + inserted


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_replace_by_key_twice_is_once(spark, hist_rows, raw_rows):
    hist = spark.createDataFrame(hist_rows, SCHEMA)
    raw = spark.createDataFrame(raw_rows, SCHEMA)
    once = replace.replace_by_key(hist, raw, "id", [("ts", "desc")])
    twice = replace.replace_by_key(once, raw, "id", [("ts", "desc")])
    assert _rows(once) == _rows(twice)


@SETTINGS
@given(st.integers(0, 60), st.integers(1, 17), st.integers(1, 6))
def test_parts_concatenate_to_input(spark, n, per_part, partitions):
    df = spark.range(n).withColumn("g", F.col("id") % 3)
    parts = chunk.chunk_rows_to_parts(df, [("g", "asc"), ("id", "desc")], per_part, num_partitions=partitions)
    got = [(r.g, r.id) for r in parts.orderBy("row_index").collect()]
    assert got == sorted(((i % 3, i) for i in range(n)), key=lambda x: (x[0], -x[1]))
    sizes = sorted(dict(parts.groupBy("part_no").count().collect()).items())
    assert all(c == per_part for _, c in sizes[:-1])
    assert sum(c for _, c in sizes) == n


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows (and NULL keys another share):
    keep-latest, merge and the subscriber join stay correct, and the
    keep-latest plan limits rows per key before the shuffle."""
    n = 30_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id END AS id",
        "CAST(id AS STRING) AS v",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
    )
    latest = dedupe.dedupe_latest(df, ["id"], [("ts", "desc")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    hot = latest.filter("id = 7").collect()
    assert len(hot) == 1 and hot[0].v == str(max(i for i in range(n) if i % 3 == 0))
    assert latest.filter("id IS NULL").count() == 1

    target = latest.filter("id IS NOT NULL").withColumn("v", F.lit("old"))
    merged = merge.merge_upsert(target, latest, ["id"])
    assert merged.filter("v = 'old'").count() == 0
    assert merged.count() == latest.count()

    events = df.select(F.col("id").alias("user_id"), "v")
    users = spark.createDataFrame(
        [(7, "sub_7", "PRO"), (7, "sub_7b", "PRO"), (8, "", "PRO")],
        "user_id long, last_subscription_id string, last_subscription_plan string",
    )
    joined = joins.join_events_subscribers(events, users)
    assert joined.count() == 2 * (n // 3 + 1)  # the hot user is listed twice: its events fan out
