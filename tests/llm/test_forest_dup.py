"""Links and components of the forest against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidewater.llm import forest_dup as fd

VECS = "vec_id long, embedding array<double>, label int, c string, leaf int, copies int"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", 1, 2) for i, v in rows], VECS).repartition(parts)


def _brute(rows, least=0.9):
    held = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = [(i, 0, i, True) for i, v in rows if not (v and all(x is not None and math.isfinite(x) for x in v) and any(v))]
    near = [
        [k for k, (_, w) in enumerate(held) if k != j and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least]
        for j, (_, v) in enumerate(held)
    ]
    for j, (i, _) in enumerate(held):
        seen, todo = {j}, [j]
        while todo:
            fresh = set(near[todo.pop()]) - seen
            seen |= fresh
            todo += fresh
        ids = [held[k][0] for k in seen if held[k][0] is not None]
        small = min(ids) if ids else None
        out.append((i, len(near[j]), small, i == small))
    return sorted(out, key=str)


def _groups(n, dim, seed, sizes=(), spread=0.2):
    """Vectors of random directions, and dense groups of the given sizes."""
    rng = np.random.default_rng(seed)
    v = [rng.normal(size=(n, dim)) / math.sqrt(dim)]
    for s in sizes:
        hub = rng.normal(size=dim)
        v.append(hub / np.linalg.norm(hub) + rng.normal(size=(s, dim)) * spread / math.sqrt(dim))
    v = np.concatenate(v)
    return [(int(i), list(map(float, v[k]))) for k, i in enumerate(rng.permutation(len(v)))]


def _got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("sample, recall", [(8192, 0.99), (100, 0.95)])
def test_forest_finds_the_links_of_all_pairs(spark, sample, recall):
    """Leaves of 32 rows, so several levels; with a sample of 100 rows leaves
    are split further by samples of their own, and groups are cut more often."""
    rows = _groups(500, 16, 3, [2, 2, 3, 5, 9, 60, 200])
    got = _got(fd.near_vectors(_frame(spark, rows), leaf=32, block=64, sample=sample))
    want = _brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no link that isn't one
    assert sum(g[1] for g in got) >= recall * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(rows)


def test_one_leaf_is_exact(spark):
    rows = _groups(150, 8, 5, [2, 20, 40])
    assert _got(fd.near_vectors(_frame(spark, rows))) == _brute(rows)


def test_blocks_and_balls_count_each_pair_once(spark, monkeypatch):
    """One dense leaf beyond a block, partly in balls, with copies."""
    monkeypatch.setattr(fd, "WORTH", 0)
    rows = _groups(10, 8, 6, [150], spread=0.35)
    rows += [(1000 + k, rows[-1][1]) for k in range(30)]
    assert _got(fd.near_vectors(_frame(spark, rows), leaf=16, block=32, trees=3)) == _brute(rows)  # three times the same leaf


def test_ball_members_are_all_linked():
    u = fd.unit(np.array([v for _, v in _groups(0, 16, 8, [400, 300])]))
    centres = fd.ball_centres(u, [np.arange(len(u))], 0.9)
    assert len(centres)
    for c in centres:
        inside = u[u @ c >= math.cos(math.acos(0.9) / 2) + 1e-9]
        assert len(inside) > 100 and (inside @ inside.T).min() >= 0.9


def test_edge_cases(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (None, None),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1e-200, 0.0]), (10, [1e300, 1e299]), (11, [-1.0, 0.0]),
        (12, [1.0, 0.0, 0.0]), (13, [3.0, 0.0, 0.1]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (14, [0.5]), (15, [-0.5]),
    ]
    got = _got(fd.near_vectors(_frame(spark, rows)))
    scaled = [(i, None if v is None else [x if x is None or not math.isfinite(x) else x / max(1e-250, max(map(abs, filter(None, v)), default=1)) for x in v]) for i, v in rows]
    assert got == _brute(scaled)
    assert fd.near_vectors(_frame(spark, rows).where("false")).collect() == []


def test_more_rows_take_more_trees():
    counts = [fd.trees_for(n, 0.9, 512) for n in (100, 10_000, 10**6, 10**9)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] < 100
