"""Periodic run detection by block convolution (operator 12).

A run is a stretch of consecutive words with smallest period ``q`` (words q
apart are identical), at least ``max(least, 2 * q)`` words long, that no
neighbouring word extends keeping that period.

Words q apart agree over ``length - q`` places of a run, so over
``max(q, least - q)`` at least, and a stretch of ``2 * b - 1`` places holds a
whole block of ``b`` words that starts at a multiple of b. Each distance is
therefore sought at one dyadic scale, the largest such b:

1. the texts of a batch are put end to end, a word of its own between two of
   them, so that no run crosses a text;
2. blocks of a scale whose word groups don't come again at the distances of
   the scale can't match and are left out (an exact test, by sorted names of
   groups of four words);
3. for the others the sum of squared differences to each place of the window
   that follows is computed for all distances at once, by number-theoretic
   transforms over a prime field; a zero names a distance;
4. what a run of smaller period already covers is dropped, and so are sums that
   are zero only modulo the prime (the words are compared). Neighbouring blocks
   with the same distance are joined and extended word by word; a stretch that
   agrees over fewer places than its distance is no run.

Every text is worked through whole, in the task that holds its row; texts up
to WORDS words share a batch, a longer one is a batch by itself. There is no
shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of the shortest run
WORDS = 1 << 18  # words of a batch of texts
BLOCK_MAX = 1 << 18  # words of the longest block that is transformed
CELLS = 1 << 19  # cells of the arrays that are transformed together
P, ROOT = 998244353, 3  # a prime that has roots of unity up to 2 ** 23, and a generator
_P = np.uint64(P)
_TWIDDLES: dict[tuple[int, bool], np.ndarray] = {}

RUNS = "array<struct<start: long, length: long, period: long>>"


def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half``."""
    if (half, inverse) not in _TWIDDLES:
        step = pow(ROOT, (P - 1) // (2 * half), P)
        step = pow(step, P - 2, P) if inverse else step
        out = np.ones(half, np.uint64)
        have = 1
        while have < half:
            out[have : 2 * have] = out[:have] * np.uint64(pow(step, have, P)) % _P
            have *= 2
        _TWIDDLES[half, inverse] = out
    return _TWIDDLES[half, inverse]


def _less(x: np.ndarray) -> np.ndarray:
    """Values below 2 P, brought below P (the subtraction wraps otherwise)."""
    return np.minimum(x, x - _P)


def transform(x: np.ndarray) -> np.ndarray:
    """Transform of each row; the result is in bit-reversed order."""
    rows, n = x.shape
    half = n // 2
    while half:
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        out = np.empty_like(v)
        out[:, :, 0] = _less(a + b)
        out[:, :, 1] = (a + (_P - b)) * _powers(half, False) % _P
        x, half = out.reshape(rows, n), half // 2
    return x


def untransform(x: np.ndarray) -> np.ndarray:
    """Inverse of :func:`transform`."""
    rows, n = x.shape
    half = 1
    while half < n:
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * _powers(half, True) % _P
        out = np.empty_like(v)
        out[:, :, 0] = _less(a + b)
        out[:, :, 1] = _less(a + (_P - b))
        x, half = out.reshape(rows, n), half * 2
    return x * np.uint64(pow(n, P - 2, P)) % _P


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, at which places of its window the block has no mismatch
    (modulo the prime): where squares of both minus twice their products sum to
    zero. ``windows`` are as wide as a power of two."""
    rows, b = blocks.shape
    n = windows.shape[1]
    block, window = blocks.astype(np.uint64), windows.astype(np.uint64)
    turned = np.zeros((rows, n), np.uint64)
    turned[:, :b] = block[:, ::-1]
    # Only the first b - 1 products wrap round; they belong to no whole place.
    products = untransform(transform(turned) * transform(window) % _P)[:, b - 1 :]
    squares = np.zeros((rows, n + 1), np.uint64)
    np.cumsum(window * window % _P, axis=1, out=squares[:, 1:])
    both = (squares[:, b:] - squares[:, :-b]) + (block * block % _P).sum(axis=1, keepdims=True)
    return both % _P == _less(products + products)


def scales(least: int, longest: int) -> list[tuple[int, int, int]]:
    """``(b, lo, hi)``: the block length of each scale and its distances, for
    runs of at most ``longest`` words."""
    q = np.arange(1, longest // 2 + 1)
    if not len(q):
        return []
    b = 1 << (np.frexp((np.maximum(q, least - q) + 1) // 2)[1] - 1)
    return [(int(x), int(q[b == x].min()), int(q[b == x].max())) for x in np.unique(b)]


def _names(x: np.ndarray) -> dict[int, np.ndarray]:
    """Names of the groups of 1, 2 and 4 words that start at each place."""
    out, width = {1: x}, 1
    for _ in range(2):
        y = out[width]
        pair = y[: len(y) - width] * (int(y.max()) + 1) + y[width:]
        out[2 * width] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return out


class _Returns:
    """Whether the group of words at a place returns at some distance."""

    def __init__(self, names: np.ndarray):
        self.names, self.n = names, len(names) + 1
        order = np.argsort(names, kind="stable")
        self.keys = names[order] * self.n + order

    def within(self, at: np.ndarray, lo: int, hi: int) -> np.ndarray:
        key = self.names[at] * self.n + at
        # A distance past the end reads keys of the next name: kept, not lost.
        found = np.searchsorted(self.keys, key + lo)
        return (found < len(self.keys)) & (self.keys[np.minimum(found, len(self.keys) - 1)] <= key + hi)


def _agree(x: np.ndarray, at: np.ndarray, d: np.ndarray, side: int) -> np.ndarray:
    """How many words from place ``at`` on (``side`` 1), or before it (-1),
    equal the words ``d`` further on. The reach doubles while all agree."""
    n, total, active, reach = len(x), np.zeros(len(at), np.int64), np.arange(len(at)), 4
    while len(active):
        still = []
        for part in np.array_split(active, -(-len(active) * reach // CELLS)):
            i = at[part, None] + side * (total[part, None] + np.arange(reach)) - (side < 0)
            j = i + d[part, None]
            ok = (i >= 0) & (j < n)
            ok &= x[np.clip(i, 0, n - 1)] == x[np.clip(j, 0, n - 1)]
            same = np.where(ok.all(axis=1), reach, ok.argmin(axis=1))
            total[part] += same
            still.append(part[same == reach])
        active, reach = np.concatenate(still), min(2 * reach, CELLS)
    return total


def _true_zeros(x: np.ndarray, i: np.ndarray, d: np.ndarray, b: int) -> np.ndarray:
    """Whether the words of each block equal those ``d`` further on."""
    out = [np.empty(0, bool)]
    for part in np.array_split(np.arange(len(i)), max(1, -(-len(i) * b // CELLS))):
        at = i[part, None] + np.arange(b)
        out.append((x[at] == x[at + d[part, None]]).all(axis=1))
    return np.concatenate(out)


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period, by start."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)
    return rows[first]


def _covered(i: np.ndarray, d: np.ndarray, b: int, known: np.ndarray) -> np.ndarray:
    """Matches inside a known run whose period is at most b / 2: they repeat
    it. Long runs of such periods overlap by less than b words, so the last
    that starts before a block is the only one that can hold it."""
    known = known[(2 * known[:, 2] <= b) & (known[:, 1] - known[:, 0] >= b)]
    if not len(known):
        return np.zeros(len(i), bool)
    k = np.searchsorted(known[:, 0], i, "right") - 1
    held = known[np.maximum(k, 0)]
    return (k >= 0) & (i + d + b <= held[:, 1]) & (d % held[:, 2] == 0)


def _matches(x: np.ndarray, starts: np.ndarray, b: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Block starts and distances without a mismatch. The window is taken in
    pieces of as many distances as fit beside the block."""
    width = 1 << int(np.ceil(np.log2(min(hi - lo + b, 4 * b))))
    width = max(width, 2 * b)
    stride, at, dist = width - b + 1, [], []
    outside = int(x.max()) + 1  # beyond the end: no word
    for first in range(lo, hi + 1, stride):
        for part in np.array_split(starts, max(1, -(-len(starts) * width // CELLS))):
            if not len(part):
                continue
            places = part[:, None] + first + np.arange(width)
            windows = np.where(places < len(x), x[np.minimum(places, len(x) - 1)], outside)
            row, gap = np.nonzero(zero_mismatches(x[part[:, None] + np.arange(b)], windows))
            ok = first + gap <= hi
            at.append(part[row[ok]])
            dist.append(first + gap[ok])
    none = [np.empty(0, np.int64)]
    return np.concatenate(at or none), np.concatenate(dist or none)


def runs_of(x: np.ndarray, least: int = LEAST, longest: int | None = None) -> np.ndarray:
    """Runs of a sequence of numbers: rows of (start, end, period) by start,
    then period. ``longest`` bounds the length of what can be a run."""
    n = len(x)
    if n < least:
        return np.empty((0, 3), np.int64)
    names = _names(x)
    returns = {w: _Returns(names[w]) for w in (1, 2, 4)}
    found = np.empty((0, 3), np.int64)
    for b, lo, hi in scales(least, min(n, longest or n)):
        b = min(b, BLOCK_MAX)
        group = min(4, b)
        starts = np.arange(0, min(n - b, len(names[group]) - 1) + 1, b)
        for o in np.unique(np.linspace(0, b - group, min(16, b - group + 1)).astype(int)):
            starts = starts[returns[group].within(starts + o, lo, hi)]
        i, d = _matches(x, starts, b, lo, hi)
        new = ~_covered(i, d, b, found)
        i, d = i[new], d[new]
        true = _true_zeros(x, i, d, b)
        i, d = i[true], d[true]
        if not len(i):
            continue
        order = np.lexsort((i, d))
        i, d = i[order], d[order]
        head = np.flatnonzero(np.r_[True, (np.diff(d) != 0) | (np.diff(i) != b)])
        tail = np.r_[head[1:], len(i)] - 1
        left, right, d = i[head], i[tail] + b, d[head]
        left, right = left - _agree(x, left, d, -1), right + _agree(x, right, d, 1)
        whole = (right - left >= d) & (right + d - left >= least)
        found = _smallest(np.concatenate([found, np.stack([left, right + d, d], axis=1)[whole]]))
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _of_texts(texts: list[list[bytes]], least: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs, and the text without repeats, of each list of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = np.r_[0, np.cumsum(sizes + 1)]
    words = np.empty(int(sizes.sum()), object)
    words[:] = [w for t in texts for w in t]
    codes, known = pd.factorize(words)
    x = np.empty(offset[-1], np.int64)
    gaps = offset[1:] - 1
    inside = np.ones(len(x), bool)
    inside[gaps] = False
    x[inside], x[gaps] = codes, len(known) + np.arange(len(texts))
    rows = runs_of(x, least, int(sizes.max(initial=0)))
    doc = np.searchsorted(offset, rows[:, 0], "right") - 1
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs, left = [], []
    for k, held in enumerate(texts):
        own = rows[first[k] : first[k + 1]] - np.array([offset[k], offset[k], 0])
        runs.append(own)
        if len(own):
            step = np.zeros(len(held) + 1, np.int64)
            np.add.at(step, own[:, 0] + own[:, 2], 1)
            np.add.at(step, own[:, 1], -1)
            held = [held[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
        left.append(b" ".join(held))
    return runs, left


def _run_batches(least: int):
    def flush(ids, texts):
        runs, left = _of_texts(texts, least)
        ends = np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32)
        rows = np.concatenate(runs)
        struct = pa.StructArray.from_arrays(
            [pa.array(v, pa.int64()) for v in (rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2])], ["start", "length", "period"]
        )
        columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(ends, struct), pa.array(left, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        ids, texts, held = [], [], 0
        for b in batches:
            for i, text in zip(b.column(0), b.column(1)):  # one cell at a time
                words = (text.as_py() or b"").split()
                if texts and held + len(words) > WORDS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i.as_py())
                texts.append(words)
                held += len(words) + 1
        if texts:
            yield flush(ids, texts)

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length and period in
    words, by start, then period) and collapsed, the text without the words
    that a run repeats: those after its first period. Kept words are joined by
    one space.

    Words are what stands between ASCII white space; they are equal if their
    bytes are. Null and empty texts have no words, no runs and an empty
    collapsed text; null and repeated ids are kept as they come, each row by
    itself. A very long text needs memory in proportion to its own length. An
    empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = rows.mapInArrow(_run_batches(least), f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of documents, a tenth of which, chosen by
    h = crc32 of the decimal id, turn periodic: from word a = g % n on (g = h //
    10, n words) each word is the one of the first p = 1 + (n - a) // (3 + g % 8)
    words from there that its place modulo p names. Other texts stay, and so do
    those with a null id."""
    planted = """
        transform(array(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)), w ->
          if(size(w) = 0, text, transform(array(named_struct('a', g % size(w),
              'p', 1 + (size(w) - g % size(w)) div (3 + g % 8))), s ->
            array_join(concat(slice(w, 1, int(s.a)),
              transform(slice(w, int(s.a) + 1, size(w)), (x, i) -> w[int(s.a + i % s.p)])), ' '))[0]))[0]"""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    return chosen.select("doc_id", F.expr(f"if(h % 10 = 0 and text is not null, {planted}, text)").alias("text"))
