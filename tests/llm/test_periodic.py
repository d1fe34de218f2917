"""Periodic runs against a comparison of all words at all distances."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidewater.llm import periodic, queries


def _brute(x, least=12):
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [4, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(600):
        letters = rng.choice([1, 2, 3, 5, 50])
        x = [rng.randrange(letters) for _ in range(rng.randint(0, 150))]
        if x and rng.random() < 0.6:
            a = rng.randrange(len(x))
            q = 1 + rng.randrange((len(x) - a) // 2 + 1)
            x[a:] = [x[min(a + i % q, len(x) - 1)] for i in range(len(x) - a)]
            x += x[a:][: rng.randint(0, 60)]
        got = [tuple(map(int, r)) for r in periodic.runs_of(np.array(x, np.int64), least)]
        assert got == _brute(x, least), x


def test_blocks_longer_than_the_bound_are_cut(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK_MAX", 8)
    monkeypatch.setattr(periodic, "CELLS", 64)
    rng = random.Random(3)
    part = [rng.randrange(40) for _ in range(300)]
    x = [*part, *part, *part[:50], 99, *([1, 2, 3] * 40)]
    assert [tuple(map(int, r)) for r in periodic.runs_of(np.array(x, np.int64))] == _brute(x)


def test_transform_finds_exact_places():
    rng = np.random.default_rng(1)
    blocks, windows = rng.integers(0, 3, (50, 4)), rng.integers(0, 3, (50, 16))
    want = np.stack([[np.array_equal(w[i : i + 4], b) for i in range(13)] for b, w in zip(blocks, windows)])
    assert np.array_equal(periodic.zero_mismatches(blocks, windows), want)
    assert np.array_equal(periodic.untransform(periodic.transform(windows.astype(np.uint64))), windows)


def test_very_long_repeat_has_one_run():
    assert periodic.runs_of(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]


def test_periodic_runs_edge_cases(docs_of):
    line = "a b c d e f "
    rows = [
        (1, line * 3), (1, line * 3), (None, "x " * 12), (2, None), (3, ""), (4, " \t\n"), (5, "x " * 11), (6, "É é " * 8),
        (7, "x\x0by " * 6 + "z"), (8, "x " * 60_000), (9, "one"), (10, "x y " * 12),
    ]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs_of(rows)).collect())
    want = [
        (0, 12, [(0, 12, 1)], "x"),
        (1, 18, [(0, 18, 6)], "a b c d e f"), (1, 18, [(0, 18, 6)], "a b c d e f"),
        (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 11, [], "x " * 10 + "x"), (6, 16, [(0, 16, 2)], "É é"),
        (7, 13, [(0, 12, 2)], "x y z"), (8, 60_000, [(0, 60_000, 1)], "x"), (9, 1, [], "one"), (10, 12, [(0, 12, 1)], "x y"),
    ]
    assert got == want
    assert periodic.periodic_runs(docs_of([(1, "a")]).where("false")).collect() == []


def _expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = _brute(words) if n < 400 else [tuple(map(int, r)) for r in periodic.runs_of(np.unique(words, return_inverse=True)[1])]
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    top = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2])) if runs else None
    return (
        len(runs),
        *((top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4),
        hashlib.sha256("".join(f"{a},{b - a},{q}\n" for a, b, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).select("doc_id", "text").collect()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in queries.QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and sum(v[0] > 0 for v in got.values()) > 10
    for r in docs:
        assert got[r.doc_id] == _expected(r.doc_id, r.text), r.doc_id
