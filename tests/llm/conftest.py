from __future__ import annotations

import pytest

from tests.conftest import duck, spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, w double, n int, label int"


@pytest.fixture
def docs_of(spark):  # noqa: F811
    """Documents from (doc_id, text) pairs, with columns whose names clash
    with those that operators use inside; null ids and texts allowed."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s" if k % 3 else None, None if t is None else len(t), "x", 1.0, 1, 0) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
