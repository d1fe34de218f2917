"""Embedding near-dedup by a forest of random-projection trees (operator 11).

Every tree splits the vectors again and again by a random direction; rows near
a split go to both sides (spill overlap). Two vectors are compared when a leaf
of some tree holds both; a pair counts only if its cosine reaches the least
one, so the forest can miss a link but adds none.

* Fitting reads a bounded sample (SAMPLE vectors). A split is put where few
  vectors of the node lie near it, so a dense group isn't cut through; where a
  split would leave more than WORTH of a node's pairs, it stays a leaf and is
  called dense. Leaves that turn out too large are split further, each by a
  sample of its own rows.
* The number of trees follows from the number of vectors: with more levels of
  splits a pair is parted more often, and the trees make up for that, so that a
  pair exactly at the least cosine is missed with probability MISS at any size.
* Equal vectors are one class throughout. A ball holds vectors within half of
  the least cosine's angle of a centre that was found in a dense leaf: they are
  all linked with each other (the angles add up), so they are counted and
  joined without comparing them.
* A leaf beyond BLOCK rows is compared in pairs of blocks, those inside one
  ball left out, so no task holds more than two blocks.
* A pair that shares several leaves counts in the first of them only; every row
  carries the list of its leaves. What leaves a task are sums per vector and a
  spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import components, land

LEAST = 0.9  # cosine of a link
LEAF, BLOCK, SAMPLE = 512, 2048, 8192
SPILL = 0.5  # width of the overlap, in deviations of a linked pair's distance along a direction
MISS = 2e-5  # probability of missing a pair at the least cosine
DIRECTIONS, TRIES, FEW, WORTH, LEFT = 32, 6, 16, 0.7, 0.58
SEED = 20250311


class Tree(NamedTuple):
    """Nodes by number: the direction and threshold of a split and its two
    children, or direction -1; ``dense`` marks leaves that can't be split."""

    seed: tuple
    direction: np.ndarray
    threshold: np.ndarray
    children: np.ndarray
    dense: np.ndarray


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one, computed in double precision."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _projected(u: np.ndarray, dim: int, seed: tuple) -> np.ndarray:
    """Rows along the directions of a tree, of the first ``dim`` components."""
    d = np.random.default_rng(seed).normal(size=(dim, DIRECTIONS))
    d /= np.linalg.norm(d, axis=0)
    width = min(dim, u.shape[1])
    return u[:, :width] @ d[:width]


def _overlap(dim: int, least: float) -> float:
    """Half the width of the strip whose rows go to both sides."""
    return SPILL * math.sqrt((2 - 2 * least) / dim) / 2


def trees_for(rows: int, least: float, leaf: int) -> int:
    """Trees after which a pair at the least cosine is missed with probability
    MISS, if every level leaves LEFT of the rows on either side."""
    depth = max(0, math.ceil(math.log(max(1, rows) / leaf) / -math.log(LEFT)))
    density, tail = math.exp(-SPILL**2 / 2) / math.sqrt(2 * math.pi), math.erfc(SPILL / math.sqrt(2)) / 2
    parted = 2 * math.sqrt(2 - 2 * least) * (density - SPILL * tail) / math.sqrt(2 * math.pi)
    together = max(1 - parted, 0.01) ** depth
    return 1 if together >= 1 else math.ceil(math.log(MISS) / math.log(1 - together))


def _split(p: np.ndarray, tau: float) -> tuple[float, float]:
    """Best threshold in the middle half and its cost: the share of all pairs
    that would still have to be compared."""
    p = np.sort(p)
    at = np.unique(np.linspace(len(p) // 4, max(len(p) // 4 + 1, 3 * len(p) // 4), 64).astype(int))
    t = (p[at - 1] + p[at]) / 2
    left, right = np.searchsorted(p, t + tau, "right"), len(p) - np.searchsorted(p, t - tau, "right")
    cost = (left.astype(float) ** 2 + right.astype(float) ** 2) / len(p) ** 2
    k = int(cost.argmin())
    return float(cost[k]), float(t[k])


def grow(u: np.ndarray, seed: tuple, share: float, leaf: int, least: float) -> tuple[Tree, list[np.ndarray]]:
    """A tree of sample rows ``u``, each of which stands for ``share`` rows,
    and the sample rows of its dense leaves."""
    dim, rng = u.shape[1], np.random.default_rng((*seed, 1))
    p, tau = _projected(u, dim, seed), _overlap(u.shape[1], least)
    direction, threshold, children, dense, held = [], [], [], [], []

    def node(rows: np.ndarray) -> int:
        me = len(direction)
        direction.append(-1), threshold.append(0.0), children.append((0, 0)), dense.append(False)
        if len(rows) * share <= leaf or len(rows) < FEW:
            return me
        tried = [(*_split(p[rows, d], tau), d) for d in rng.choice(DIRECTIONS, TRIES, replace=False)]
        cost, t, d = min(tried)
        if cost > WORTH:
            dense[me] = True
            held.append(rows)
            return me
        direction[me], threshold[me] = int(d), t
        children[me] = (node(rows[p[rows, d] <= t + tau]), node(rows[p[rows, d] > t - tau]))
        return me

    node(np.arange(len(u)))
    return Tree(seed, np.array(direction), np.array(threshold), np.array(children), np.array(dense)), held


def route(tree: Tree, u: np.ndarray, dim: int, least: float) -> list[tuple[int, np.ndarray]]:
    """(leaf, its rows) of a tree fitted on ``dim`` components."""
    p, tau, out = _projected(u, dim, tree.seed), _overlap(dim, least), []
    todo = [(0, np.arange(len(u)))]
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        if tree.direction[k] < 0:
            out.append((k, rows))
            continue
        at, t = p[rows, tree.direction[k]], tree.threshold[k]
        todo += [(tree.children[k, 0], rows[at <= t + tau]), (tree.children[k, 1], rows[at > t - tau])]
    return out


def ball_centres(u: np.ndarray, groups: list[np.ndarray], least: float) -> np.ndarray:
    """Centres of balls that cover most sample rows of dense leaves."""
    near = math.cos(math.acos(least) / 2)
    centres = []
    for rows in groups:
        left = u[rows]
        while len(left) >= FEW:
            close = left @ left.T >= near
            centre = left[close.sum(axis=1).argmax()]
            for _ in range(3):  # towards the middle of what it covers
                inside = left @ centre >= near
                if inside.any():
                    centre = left[inside].sum(axis=0)
                    centre /= np.linalg.norm(centre)
            inside = left @ centre >= near
            if inside.sum() < FEW:
                break
            centres.append(centre)
            left = left[~inside]
    return np.array(centres).reshape(len(centres), u.shape[1])


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, unit vectors) of a column of equal or mixed sizes."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
    out = []
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        out.append((int(dim), rows, unit(flat[ends[rows][:, None] + np.arange(dim)])))
    return out


_MEMBER = "c long, ball int, leaf long, dense boolean"


def _leaf_id(*parts: int) -> int:
    """A leaf's number among all; leaves of different dimensions differ."""
    return int.from_bytes(hashlib.blake2b(repr(tuple(map(int, parts))).encode(), digest_size=8).digest(), "big", signed=True)


def _planted(trees: list[Tree], dim: int, centres: np.ndarray, least: float):
    """Leaves and ball of each vector."""
    near = math.cos(math.acos(least) / 2) + 1e-9

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, ball, out = b.column(0).to_numpy(), np.full(b.num_rows, -1, np.int32), []
            for size, rows, u in _matrix(b.column(1)):
                if len(centres) and size == dim:
                    cosine = u @ centres.T
                    best = cosine.argmax(axis=1)
                    ball[rows] = np.where(cosine[np.arange(len(rows)), best] >= near, best, -1)
                for t, tree in enumerate(trees):
                    for k, held in route(tree, u, dim, least):
                        out.append((rows[held], _leaf_id(size, t, k), bool(tree.dense[k])))
            at = np.concatenate([o[0] for o in out])
            counts = [len(o[0]) for o in out]
            columns = [pa.array(ids[at], pa.int64()), pa.array(ball[at], pa.int32())]
            columns += [pa.array(np.repeat([o[1] for o in out], counts), pa.int64()), pa.array(np.repeat([o[2] for o in out], counts))]
            yield pa.RecordBatch.from_arrays(columns, names=["c", "ball", "leaf", "dense"])

    return run


def _regrown(leaf: int, least: float):
    """A tree for the sampled rows of one large leaf."""

    def run(key, pdf):
        u = unit(np.array(pdf["v"].to_list()))
        tree, _ = grow(u, (SEED, key[0] & (2**63 - 1)), float(pdf["size"].iloc[0]) / len(u), leaf, least)
        return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps((tree, u.shape[1]))]})

    return run


def _rerouted(least: float):
    def run(pdfs):
        for pdf in pdfs:
            out = []
            for leaf, rows in pdf.groupby("leaf"):
                tree, dim = pickle.loads(rows["tree"].iloc[0])
                for k, held in route(tree, unit(np.array(rows["v"].to_list())), dim, least):
                    part = rows.iloc[held][["c", "ball"]]
                    out.append(part.assign(leaf=_leaf_id(leaf, k), dense=bool(tree.dense[k])))
            if out:
                yield pd.concat(out)

    return run


def _split_large(members: DataFrame, classes: DataFrame, leaf: int, block: int, sample: int, least: float) -> DataFrame:
    """Members after every leaf beyond ``block`` rows is split further, but
    for dense ones."""
    while True:
        sizes = members.where("not dense").groupBy("leaf").agg(F.count("*").alias("size"))
        large = land(sizes.where(F.col("size") > block), "forest-large")
        if large.isEmpty():
            return members
        held = members.join(large, "leaf").join(classes.select("c", "v"), "c")
        u = F.pmod(F.xxhash64("c", "leaf"), F.lit(1 << 30)) / (1 << 30)
        # At most about `sample` rows of each leaf, whatever its size.
        trees = land(
            held.where(u * F.col("size") < sample).select("leaf", "size", "v").groupBy("leaf")
            .applyInPandas(_regrown(leaf, least), "leaf long, tree binary"),
            "forest-trees",
        )
        split = held.join(trees, "leaf").select("c", "ball", "leaf", "v", "tree").mapInPandas(_rerouted(least), _MEMBER)
        members = land(members.join(large, "leaf", "left_anti").select("c", "ball", "leaf", "dense").union(split), "forest-members")


def _compared(least: float):
    """Links inside a leaf, or between two blocks of it: sums per vector
    (``b`` null) and edges of a spanning forest (``links`` null)."""

    def run(key, pdf):
        leaf, lo, hi = key
        c, copies, ball = (pdf[x].to_numpy(np.int64) for x in ("c", "copies", "ball"))
        u = unit(np.array(pdf["v"].to_list()))
        one = np.arange(len(c)) if lo == hi else np.flatnonzero(pdf["block"] == lo)
        other = one if lo == hi else np.flatnonzero(pdf["block"] == hi)
        i, j = [], []
        for at in range(0, len(one), 512):
            part = one[at : at + 512]
            ok = u[part] @ u[other].T >= least
            ok &= (ball[part, None] < 0) | (ball[part, None] != ball[other])
            if lo == hi:
                ok &= part[:, None] < other
            x, y = np.nonzero(ok)
            i.append(part[x])
            j.append(other[y])
        i, j = np.concatenate(i), np.concatenate(j)
        # The first common leaf counts a pair.
        lists = pdf["leaves"].to_list()
        used = np.unique(np.concatenate([i, j]))
        member = np.repeat(used, [len(lists[k]) for k in used])
        earlier = np.concatenate([lists[k] for k in used]) if len(used) else np.empty(0, np.int64)
        member, earlier = member[earlier < leaf], earlier[earlier < leaf]
        _, column, times = np.unique(earlier, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        member, column = member[shared], np.unique(column[shared], return_inverse=True)[1]
        bits = np.zeros((len(c), (column.max(initial=-1) + 8) // 8), np.uint8)
        np.bitwise_or.at(bits, (member, column // 8), (1 << (column % 8)).astype(np.uint8))
        new = np.ones(len(i), bool)
        for at in range(0, len(i), 1 << 18):
            part = slice(at, at + (1 << 18))
            new[part] = ~(bits[i[part]] & bits[j[part]]).any(axis=1)
        i, j = i[new], j[new]
        links = np.bincount(i, copies[j], len(c)) + np.bincount(j, copies[i], len(c))
        label = np.arange(len(c))
        while True:
            least_ = label.copy()
            np.minimum.at(least_, i, label[j])
            np.minimum.at(least_, j, label[i])
            least_ = np.minimum(least_, least_[least_])
            if (least_ == label).all():
                break
            label = least_
        linked, hung = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(c)))
        sums = pd.DataFrame({"a": c[linked], "b": None, "links": links[linked].astype(np.int64)})
        edges = pd.DataFrame({"a": c[hung], "b": c[label[hung]], "links": None})
        return pd.concat([sums.astype(object), edges.astype(object)])

    return run


def _blocks(members: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Members ``(c, leaf, block)`` of leaves beyond ``block`` rows, each block
    inside one ball or outside all, and the pairs of blocks to compare."""
    sizes = members.groupBy("leaf", "ball").agg(F.count("*").alias("n"))
    before = Window.partitionBy("leaf").orderBy("ball").rowsBetween(Window.unboundedPreceding, -1)
    many = F.ceil(F.col("n") / block)
    kinds = land(sizes.withColumn("many", many).withColumn("first", F.coalesce(F.sum("many").over(before), F.lit(0))), "forest-blocks")
    dealt = members.join(kinds, ["leaf", "ball"]).select("c", "leaf", (F.col("first") + F.pmod(F.xxhash64("c"), F.col("many"))).alias("block"))
    each = kinds.select("leaf", "ball", F.explode(F.sequence("first", F.col("first") + F.col("many") - 1)).alias("block"))
    lo, hi = each.toDF("leaf", "ball_lo", "lo"), each.toDF("leaf", "ball_hi", "hi")
    pairs = lo.join(hi, "leaf").where("lo <= hi and not (ball_lo >= 0 and ball_lo = ball_hi)").select("leaf", "lo", "hi")
    return dealt, pairs


def near_vectors(
    vectors: DataFrame, least: float = LEAST, leaf: int = LEAF, block: int = BLOCK, sample: int = SAMPLE, trees: int | None = None
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows linked with it
    directly), component_id (the smallest id reachable over links) and kept.

    Rows are linked by a cosine of at least ``least`` in double precision,
    whatever their labels. Rows whose vector is null, empty or zero, or holds a
    null or non-finite component, are linked with nothing and kept, and so are
    vectors without any of their own dimension near. Rows that repeat a vector
    are linked; rows that share an id are told apart and count one each. Null
    ids take part, but are never the smallest, unless all are null. An empty
    table gives no rows; other columns are ignored.
    """
    x = F.col("embedding")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    useful = F.coalesce(sound & F.exists(x, lambda e: e != 0), F.lit(False))
    rows = land(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(useful, x).alias("v")), "forest-rows")
    grouped = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = land(grouped.withColumn("c", F.monotonically_increasing_id()), "forest-classes")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    fitted = [r["v"] for r in classes.orderBy(F.xxhash64("c")).limit(sample).select("v").collect()]
    if not fitted:
        return alone
    total, dim = classes.count(), max(map(len, fitted))
    # Shorter vectors are filled up with zeros; only routing sees that.
    u = unit(np.array([[*v, *[0.0] * (dim - len(v))] for v in fitted]))
    share = max(1.0, total / len(u))
    grown = [grow(u, (SEED, t), share, leaf, least) for t in range(trees or trees_for(total, least, leaf))]
    centres = ball_centres(u, grown[0][1], least)
    planted = classes.select("c", "v").mapInArrow(_planted([t for t, _ in grown], dim, centres, least), _MEMBER)
    members = _split_large(land(planted, "forest-members"), classes, leaf, block, sample, least)

    sizes = land(members.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1"), "forest-sizes")
    small = members.join(sizes.where(F.col("size") <= block), "leaf", "left_semi").select(
        "c", "leaf", *[F.lit(0).cast("long").alias(x) for x in ("block", "lo", "hi")]
    )
    dealt, pairs = _blocks(members.join(sizes.where(F.col("size") > block), "leaf", "left_semi"), block)
    both = pairs.select("leaf", "lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    placed = small.union(dealt.join(both, ["leaf", "block"]).select("c", "leaf", "block", "lo", "hi"))
    listed = members.groupBy("c").agg(F.first("ball").alias("ball"), F.collect_list("leaf").alias("leaves"))
    full = classes.select("c", "v", "copies").join(listed, "c")
    found = land(
        placed.join(full, "c").groupBy("leaf", "lo", "hi").applyInPandas(_compared(least), "a long, b long, links long"), "forest-links"
    )

    in_ball = land(full.where("ball >= 0").select("c", "ball", "copies"), "forest-balls")
    balls = in_ball.groupBy("ball").agg(F.sum("copies").alias("all"))  # at most one row per sampled vector
    inside = in_ball.join(balls, "ball").select("c", (F.col("all") - F.col("copies")).alias("links"))
    # A ball is a node of its own, with a number that no class has.
    hung = in_ball.select(F.col("c").alias("a"), (-1 - F.col("ball")).cast("long").alias("b"))
    comp = land(components(found.where("b is not null").select("a", "b").union(hung), "forest"), "forest-components")
    sums = found.where("b is null").select(F.col("a").alias("c"), "links").union(inside).groupBy("c").agg(F.sum("links").alias("links"))
    labelled = land(
        classes.select("c", "copies", "least").join(sums, "c", "left").join(comp, classes["c"] == comp["node"], "left").select(
            "c", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "c").alias("label")
        ),
        "forest-labelled",
    )
    smallest = land(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "forest-smallest")
    of_class = labelled.join(smallest, "label").select("c", "n_links", "component_id")
    result = rows.join(classes.select("v", "c"), "v").join(of_class, "c").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return result.union(alone)
