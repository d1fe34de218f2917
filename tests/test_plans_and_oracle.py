"""Plan properties and the oracle comparison on the smallest scale factor."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 26
    assert df.count() >= 0


def test_no_python_eval_in_core_plans(spark):
    q = E.queries()
    for key in ("curated_day", "merge_upsert_latest", "dedupe_latest", "filter_nps_event", "job_replicate_orders"):
        plan = _plan(q[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_dedupe_limits_before_shuffle(spark):
    plan = _plan(E.queries()["dedupe_latest"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_chunking_has_no_single_partition_exchange(spark):
    df = E.queries()["chunk_rows_to_parts"](spark, SF_SMALL)
    df.count()
    assert "SinglePartition" not in _plan(df)


def test_watermark_is_a_scalar_subquery_not_a_join(spark):
    plan = _plan(E.queries()["filter_late_rows"](spark, SF_SMALL))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


ORACLE_KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(sdf.columns, srows) == _digest(ocols, orows)


def _exchanges(df) -> int:
    return _plan(df).count("Exchange hashpartitioning")


def test_merge_into_bucketed_target_shuffles_only_the_batch(spark):
    from tidewater import fixtures as fx
    from tidewater.operators import dedupe, merge, project
    from tidewater.sinks import tables

    final = fx.orders_final(spark, SF_SMALL)
    tables.save_bucketed(final, "t_orders_final_bucketed", ["id"], 8)
    src = dedupe.dedupe_latest(project.project_snake_case(fx.orders_raw(spark, SF_SMALL)), ["id"], [("updated_at", "desc")])
    plain = merge.merge_upsert(spark.read.parquet(SF_SMALL + "/orders.parquet").selectExpr(
        "o_custkey AS id", "o_orderkey AS order_no", "o_orderstatus AS status",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total", "o_orderdate AS updated_at"), src, ["id"])
    bucketed = merge.merge_upsert(tables.read_table(spark, "t_orders_final_bucketed"), src, ["id"])
    assert "Bucketed: true" in bucketed._jdf.queryExecution().executedPlan().toString() or _exchanges(bucketed) < _exchanges(plain)
    assert _exchanges(bucketed) < _exchanges(plain)
    expected = sorted(map(tuple, merge.merge_upsert(final, src, ["id"]).collect()), key=repr)
    assert sorted(map(tuple, bucketed.collect()), key=repr) == expected


def test_replace_partitions_drops_emptied_day(spark):
    import os
    import tempfile

    from tidewater.sinks import files

    path = os.path.join(tempfile.mkdtemp(prefix="tw-parts-"), "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id long, day string")
    df.write.partitionBy("day").parquet(path)
    rebuilt = spark.createDataFrame([(3, "2024-01-01")], "id long, day string")
    files.replace_partitions(rebuilt, path, ["day"], touched=["2024-01-01", "2024-01-02"])
    got = sorted((r.id, str(r.day)) for r in spark.read.parquet(path).collect())
    assert got == [(3, "2024-01-01")]


def test_snapshot_pointer_round_trip(spark):
    import tempfile

    from tidewater.sinks import files

    root = tempfile.mkdtemp(prefix="tw-snap-")
    files.write_snapshot(spark.range(3), root)
    files.write_snapshot(files.read_current(spark, root).filter("id > 0"), root)
    assert sorted(r.id for r in files.read_current(spark, root).collect()) == [1, 2]


def test_refresh_tracking_day_table_rewrites_only_that_day(spark):
    import os
    import tempfile

    from pyspark.sql import functions as F

    from tidewater import fixtures as fx
    from tidewater.functions import time as TM
    from tidewater.plans import jobs

    path = os.path.join(tempfile.mkdtemp(prefix="tw-track-"), "t")
    ev, users = fx.tracking_events(spark, SF_SMALL), fx.dim_users(spark, SF_SMALL)
    zone = "America/Chicago"
    full = jobs.curate_tracking(ev, users).withColumn(
        "local_date", TM.local_date_of(TM.millis_to_ntz(F.col("timestamp")), zone)
    )
    full.write.partitionBy("local_date").parquet(path)
    other = sorted(os.listdir(path))
    jobs.refresh_tracking_day_table(path, ev, users, "2024-01-10", "2024-01-11", zone)
    table = spark.read.parquet(path)
    assert table.count() == full.count()
    jobs.refresh_tracking_day_table(path, ev.filter(F.lit(False)), users, "2024-01-10", "2024-01-11", zone)
    after = sorted(os.listdir(path))
    assert "local_date=2024-01-10" not in after and set(after) == set(other) - {"local_date=2024-01-10"}


def test_queries_are_listed_without_a_session():
    """The driver imports the entry before it has a Spark session."""
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 80"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
