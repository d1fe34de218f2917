"""Registered queries against their SQL, and the pipeline."""

from __future__ import annotations

import os

import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from tests.conftest import SF_SMALL
from tidewater.llm import queries


def _rows(df):
    return sorted(str(tuple("" if pd.isna(v) else int(v) if isinstance(v, float) and v == int(v) else v for v in r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(queries.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols and _rows(got[cols]) == _rows(want[cols])


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 1 + len(queries.QUERIES)))
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    before, counts = docs.count(), []
    from tidewater.llm.common import land

    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = land(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert out.columns == docs.columns
        ids = out.select("doc_id")
        assert ids.join(docs, "doc_id", "left_anti").isEmpty()
        counts.append(out.count())
        docs = out
    assert before > counts[0] == counts[1] > counts[2] > counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert last.select("doc_id").distinct().count() == counts[3]
