"""Hard negatives against all pairs, and the bounds of segment summaries."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidewater.llm import hard_negatives as hn

VECS = "vec_id long, embedding array<double>, label int, v string, score int, place int"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECS).repartition(parts)


def _brute(rows, every, k, m, floor=30, ceiling=90, scale=256):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(scale * x) for x in v])
        held[i] = min(held.get(i, row), row)
    out = []
    for a, (label, v) in held.items():
        if a % every:
            continue
        score = {b: sum(map(int.__mul__, v, w)) for b, (_, w) in held.items() if b != a and len(w) == len(v)}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if held[b][0] == label][:k]:
            fit = [b for b in order if held[b][0] != label and floor * score[p] <= 100 * score[b] <= ceiling * score[p]]
            out += [(a, p, r + 1, b, score[p], score[b]) for r, b in enumerate(fit[:m])]
    return sorted(out)


def _clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(6, dim))
    hubs /= np.linalg.norm(hubs, axis=1, keepdims=True)
    v = hubs[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * rng.choice([0.02, 0.1, 0.3], (n, 1))
    return v, rng.integers(0, 3, n)


@pytest.mark.parametrize("dim", [1, 5, 32])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, dim):
    monkeypatch.setattr(hn, "VECTORS", 16)
    monkeypatch.setattr(hn, "ANCHORS", 8)
    v, labels = _clustered(300, dim, dim)
    rows = [(i, list(map(float, x)), int(y)) for i, (x, y) in enumerate(zip(v, labels))]
    got = sorted(map(tuple, hn.hard_negatives(_frame(spark, rows), every=10, negatives=4).collect()))
    assert got == _brute(rows, 10, 5, 4) and got


def test_hard_negatives_edge_cases(spark):
    rng = random.Random(2)
    v = lambda d=3: [rng.choice([0.0, 0.5, -0.25]) for _ in range(d)]
    rows = [(i, v(), i % 4) for i in range(60)]  # many ties
    rows += [(0, v(), 3), (2, rows[2][1], 2), (100, None, 1), (101, [], 1), (102, [], 2), (104, [], 1), (103, v(4), 1), (106, v(4), 2)]
    rows += [(None, v(), 1), (107, v(), None), (108, [1.0, None, 2.0], 1), (109, [1.0, math.nan, 0.0], 1), (110, [math.inf, 0.0, 0.0], 1)]
    rows += [(200, [-1.0, 0.0, 0.0], 9), (201, [1.0, 0.0, 0.0], 9)]  # the only positive has a negative score
    got = sorted(map(tuple, hn.hard_negatives(_frame(spark, rows), every=2).collect()))
    assert got == _brute(rows, 2, 5, 10) and got
    assert hn.hard_negatives(_frame(spark, rows).where("false")).collect() == []
    assert hn.hard_negatives(_frame(spark, [(0, [1.0], 1)]), every=1).collect() == []


def _block(v, labels):
    x = np.floor(256 * v).astype(np.int64)
    row = {"ids": np.arange(len(x)).tobytes(), "labels": labels.astype(np.int64).tobytes(), "data": x.tobytes()}
    return hn.Block(row | {"summary": hn.summaries(x).tobytes(), "dim": x.shape[1], "ranges": None})


@pytest.mark.parametrize("dim", [1, 7, 64])
def test_summaries_bound_every_score(dim):
    v, labels = _clustered(200, dim, 7)
    b = _block(v, labels)
    exact, before = b.v @ b.v.T, None
    for mean, dev in hn.levels(dim):
        middle, spread = b.s[:, mean] @ b.s[:, mean].T, b.s[:, dev] @ b.s[:, dev].T + 0.5
        assert (middle - spread <= exact).all() and (exact <= middle + spread).all()
        assert before is None or spread.sum() <= before
        before = spread.sum()


def test_bounds_spare_exact_scores():
    """Smooth vectors, whose segments are nearly flat, are told apart by them."""
    rng = np.random.default_rng(4)
    v = np.repeat(rng.normal(size=(2000, 8)), 8, axis=1) + rng.normal(size=(2000, 64)) * 0.05
    b = _block(v, np.zeros(2000))
    best, exact = hn.best_of_label(b, iter([b]), 5)
    _, again = hn.best_of_label(b, iter([b, b]), 5)
    assert again - exact < 0.1 * 2000 * 2000
    want = np.sort(np.where(np.eye(2000, dtype=bool), hn.NONE, b.v @ b.v.T), axis=1)[:, :-6:-1]
    assert (best.scores == want).all()
