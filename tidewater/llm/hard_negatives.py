"""Hard-negative mining with segment summary filtering (operator 13).

A vector is cut into segments, at several levels from one segment to many. Of
each segment the mean and the deviation are stored. Over a segment of L
components two vectors' product is L times the product of their means, plus or
minus at most the product of their deviations (Cauchy-Schwarz on what is left
when the means are taken out). Summed over the segments that bounds a score
from both sides, and more segments bound it tighter.

1. Vectors lie in blocks, in the order of their labels, with their summaries.
2. Each block of anchors meets the blocks that hold its labels. A pair whose
   upper bound stays below the anchor's running k-th best score is dropped,
   level by level; the rest is scored exactly. The best k are the positives.
3. Each block of anchors, now with the score range that each positive allows,
   meets the blocks of other labels. A pair is dropped when its upper bound
   stays below all ranges (or below the negatives found already), or its lower
   bound lies above them; the rest is scored exactly.

A block of anchors is met in STRIPES streams, each with one running list per
anchor, so the lists grow with the anchors and not with the blocks. A task
holds one block of anchors, its lists, and one block of vectors at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import land
from tidewater.llm.topk import _product as exact_product

SCALE, POSITIVES, NEGATIVES, EVERY = 256, 5, 10, 100
FLOOR, CEILING = 30, 90  # a negative's score in per cent of its positive's
SEGMENTS = (1, 4, 16)
ANCHORS, VECTORS, STRIPES = 1024, 1024, 8
AT_ONCE = 256  # anchors that are compared with a block of vectors at a time
NONE = np.iinfo(np.int64).min


def labelled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` with floor(scale * x) per component. Rows without
    id, label or vector, and those with a null or non-finite component, take no
    part; of rows that share an id the one with the smallest label, then the
    smallest vector, counts."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("embedding"))
    whole = F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e).cast("long")).alias("v")
    return (
        rows.where("vec_id is not null and label is not null and embedding is not null").where(finite)
        .select("vec_id", F.struct("label", whole).alias("row"))
        .groupBy("vec_id").agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.v")
    )


def summaries(v: np.ndarray) -> np.ndarray:
    """Per vector the scaled means, then the deviations, of each level."""
    n, dim = v.shape
    x = v.astype(np.float64)
    out = []
    for count in SEGMENTS if dim else ():
        edges = np.linspace(0, dim, min(count, dim) + 1).astype(int)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / np.sqrt(np.diff(edges))
        out += [mean, np.sqrt(np.maximum(np.add.reduceat(x * x, edges[:-1], axis=1) - mean * mean, 0))]
    return np.concatenate(out, axis=1) if out else np.zeros((n, 0))


def levels(dim: int) -> list[tuple[slice, slice]]:
    """Where a summary holds each level's means and deviations."""
    out, at = [], 0
    for count in SEGMENTS if dim else ():
        s = min(count, dim)
        out.append((slice(at, at + s), slice(at + s, at + 2 * s)))
        at += 2 * s
    return out


class Block:
    """Vectors of one dimension with ids, labels and summaries."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.v = np.frombuffer(row["data"], np.int64).reshape(len(self.ids), row["dim"])
        self.s = np.frombuffer(row["summary"], np.float64).reshape(len(self.ids), -1)
        self.ranges = np.frombuffer(row["ranges"] or b"", np.int64)


def scored(
    a: Block, b: Block, rows: slice, open_: np.ndarray, able: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, int]:
    """Exact scores of those open pairs of ``a[rows]`` and ``b`` that their
    bounds leave able, NONE elsewhere, and how many were scored."""
    q, x = a.s[rows], b.s
    norm = lambda s: np.sqrt((s[:, :2] ** 2).sum(axis=1).max(initial=0))
    slack = 0.5 + 1e-6 * norm(q) * norm(x)  # rounding never drops a pair
    for mean, dev in levels(a.v.shape[1]):
        if not open_.any():
            break
        middle, spread = q[:, mean] @ x[:, mean].T, q[:, dev] @ x[:, dev].T + slack
        open_ &= able(middle - spread, middle + spread)
    out, left = np.full(open_.shape, NONE), int(open_.sum())
    if 8 * left > open_.size:
        out = np.where(open_, exact_product(a.v[rows], b.v), NONE)
    elif left:
        i, j = np.nonzero(open_)
        out[i, j] = np.einsum("ij,ij->i", a.v[rows][i], b.v[j])
    return out, left


class Best:
    """The ``k`` highest scores of each of ``n`` lists; ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.full((n, k), NONE), np.zeros((n, k), np.int64)

    @property
    def least(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of lists ``rows``, a column per id; NONE is no score."""
        least = self.least[rows]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        i, j = np.nonzero((scores >= least[:, None]) & (scores != NONE))
        if not len(i):
            return
        touched = np.unique(i)
        held = rows[touched]
        old = self.scores[held] != NONE
        row = np.concatenate([np.nonzero(old)[0], np.searchsorted(touched, i)])
        score, id_ = np.concatenate([self.scores[held][old], scores[i, j]]), np.concatenate([self.ids[held][old], ids[j]])
        order = np.lexsort((id_, -score, row))
        row, score, id_ = row[order], score[order], id_[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        ok = place < self.k
        self.scores[held], self.ids[held] = NONE, 0
        self.scores[held[row[ok]], place[ok]], self.ids[held[row[ok]], place[ok]] = score[ok], id_[ok]


_BLOCK = "dim int, block long, first long, last long, ids binary, labels binary, data binary, summary binary, ranges binary"


def _pack(size: int):
    """Sorted rows to blocks of one dimension each."""

    def block(number, dim, ids, labels, v, ranges):
        x = np.array(v, np.int64).reshape(len(ids), dim)
        values = [dim, number, labels[0], labels[-1], np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes()]
        values += [x.tobytes(), summaries(x).tobytes(), np.array(ranges, np.int64).tobytes()]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types)], names=[c.split()[0] for c in _BLOCK.split(", ")])

    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, []

        def flush():
            return block(number, len(held[0][2]), *zip(*held)) if held else None

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if held and (len(held) >= size or len(held[0][2]) != len(row[2])):
                    yield flush()
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield flush()

    return run


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Landed blocks of at most ``size`` rows ``(vec_id, label, v, ranges)`` in
    the order of dimension and label; a hot label has many blocks."""
    keys = [F.size("v"), F.col("label"), F.xxhash64("vec_id")]
    ordered = rows.select("vec_id", "label", "v", "ranges").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return land(ordered.mapInArrow(_pack(size), _BLOCK), name)


def _streams(anchors: DataFrame, data: DataFrame, meets) -> DataFrame:
    """Each block of anchors, followed by the blocks that it meets, in STRIPES
    streams. Which blocks meet is settled without their vectors."""
    payload = ["dim", "ids", "labels", "data", "summary", "ranges"]
    of = anchors.select("dim", F.col("block").alias("a_block"), F.col("first").alias("a_first"), F.col("last").alias("a_last"))
    pairs = data.select("dim", "block", "first", "last").join(of, "dim").where(meets)
    pairs = pairs.select("block", "a_block", F.pmod(F.xxhash64("block"), F.lit(STRIPES)).alias("stripe"))
    met = pairs.join(data.select("block", *payload), "block").select("a_block", "stripe", "block", *payload)
    heads = pairs.select("a_block", "stripe").distinct().join(anchors.withColumnRenamed("block", "a_block"), "a_block")
    both = heads.select("a_block", "stripe", F.lit(-1).cast("long").alias("block"), *payload).union(met)
    key = ["a_block", "stripe"]
    tasks = max(1, int(data.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(tasks, *key).sortWithinPartitions(*key, "block")


def _followed(batches) -> Iterator[tuple[Block, Iterator[Block]]]:
    """(block of anchors, blocks that it meets) of a sorted partition."""
    rows = ({c: b.column(c)[i].as_py() for c in b.schema.names} for b in batches for i in range(b.num_rows))
    row = next(rows, None)
    while row is not None:
        head, key = Block(row), (row["a_block"], row["stripe"])

        def met():
            nonlocal row
            row = next(rows, None)
            while row is not None and (row["a_block"], row["stripe"]) == key:
                yield Block(row)
                row = next(rows, None)

        yield head, met()


def _parts(n: int) -> list[slice]:
    return [slice(i, min(i + AT_ONCE, n)) for i in range(0, n, AT_ONCE)]


def best_of_label(a: Block, data: Iterator[Block], k: int) -> tuple[Best, int]:
    """Running lists of each anchor's best rows of its label, and the number
    of exact scores."""
    best, exact = Best(len(a.ids), k), 0
    for b in data:
        for part in _parts(len(a.ids)):
            open_ = (a.labels[part, None] == b.labels) & (a.ids[part, None] != b.ids)
            least = best.least[part, None]
            score, n = scored(a, b, part, open_, lambda low, high: high >= least)  # noqa: B023
            best.add(np.arange(part.start, part.stop), score, b.ids)
            exact += n
    return best, exact


def best_in_ranges(a: Block, data: Iterator[Block], k: int) -> tuple[Best, int]:
    """Running lists of each range of each anchor: the best rows of other
    labels whose score lies in it; and the number of exact scores."""
    n = len(a.ids)
    lo, hi = np.moveaxis(a.ranges.reshape(n, -1, 2), 2, 0)
    width = lo.shape[1]
    best, exact = Best(n * width, k), 0
    for b in data:
        for part in _parts(n):
            open_ = (a.labels[part, None] != b.labels) & (a.ids[part, None] != b.ids)
            least = np.maximum(best.least.reshape(n, width)[part], lo[part])
            used = lo[part] <= hi[part]
            from_ = np.where(used, least, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)[:, None]
            to = np.where(used, hi[part], NONE).max(axis=1, initial=NONE)[:, None]
            score, m = scored(a, b, part, open_, lambda low, high: (high >= from_) & (low <= to))  # noqa: B023
            exact += m
            for r in range(width):
                fits = (score >= least[:, r, None]) & (score <= hi[part][:, r, None])
                best.add(np.arange(part.start, part.stop) * width + r, np.where(fits, score, NONE), b.ids)
    return best, exact


def _lists(find, k: int):
    """Rows (anchor, place of its list, other id, score) of running lists."""

    def run(batches):
        for a, data in _followed(batches):
            best, _ = find(a, data, k)
            row, place = np.nonzero(best.scores != NONE)
            width = max(1, len(best.scores) // max(1, len(a.ids)))
            columns = (a.ids[row // width], row % width, best.ids[row, place], best.scores[row, place])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "list", "other_id", "score"])

    return run


_LISTS = "anchor_id long, list long, other_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "list").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    floor: int = FLOOR,
    ceiling: int = CEILING,
    scale: int = SCALE,
) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its
    ``positives`` best rows of the same label: the best ``negatives`` rows of
    other labels with ``floor * p <= 100 * score <= ceiling * p``, p the
    positive's score. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    A score is the integer inner product of floor(scale * x); higher ones come
    first, ties by smaller id, and fewer rows are listed where fewer fit. See
    :func:`labelled_vectors` for rows that take no part and for repeated ids.
    Vectors of different dimensions have no score. An empty table gives no
    rows; other columns are ignored. Sums must fit into 64 bits.
    """
    rows = land(labelled_vectors(vectors, scale), "negatives-vectors")
    none = F.array().cast("array<long>").alias("ranges")
    data = blocks(rows.select("*", none), VECTORS, "negatives-blocks")
    chosen = rows.where(F.col("vec_id") % every == 0)
    anchors = blocks(chosen.select("*", none), ANCHORS, "negatives-anchors")
    same = F.expr("first <= a_last and a_first <= last")
    found = _streams(anchors, data, same).mapInArrow(_lists(best_of_label, positives), _LISTS)
    nearest = land(_best(found, positives).select("anchor_id", (F.col("rank") - 1).alias("place"), "other_id", "score"), "negatives-positives")

    # floor * p <= 100 * n <= ceiling * p in whole numbers; nothing fits a
    # negative p when the floor is below the ceiling.
    fits = f"score >= 0 and {floor} <= {ceiling}"
    low, high = f"if({fits}, ({floor} * score + 99) div 100, 1L) as lo", f"if({fits}, {ceiling} * score div 100, 0L) as hi"
    limits = nearest.selectExpr("anchor_id", "place", low, high).groupBy("anchor_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "lo", "hi"))), lambda r: F.array(r["lo"], r["hi"])).alias("r")
    )
    filled = F.flatten(F.concat("r", F.array_repeat(F.array(F.lit(1).cast("long"), F.lit(0).cast("long")), F.lit(positives) - F.size("r"))))
    ranged = chosen.join(limits, chosen["vec_id"] == limits["anchor_id"]).select("vec_id", "label", "v", filled.alias("ranges"))
    anchors = blocks(ranged, ANCHORS, "negatives-ranges")
    other = F.expr("not (first = last and a_first = a_last and first = a_first)")
    found = _streams(anchors, data, other).mapInArrow(_lists(best_in_ranges, negatives), _LISTS)
    mined = _best(found, negatives).select("anchor_id", F.col("list").alias("place"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = nearest.select("anchor_id", F.col("place").cast("long").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(of, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
