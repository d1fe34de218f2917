"""Exact top-k search by a three-phase uniform threshold (operator 6).

A score is the inner product of integer vectors. The dimensions are split
into ``parts``; a node of the method is one part of one block of vectors, and
scores a query's part against it.

1. Every node gives its local list: a query's ``k`` highest partial scores.
   The candidates named there are scored in full; a query's ``k``-th highest
   is a safe cutoff, for at least ``k`` rows reach it.
2. The cutoff goes to every node. A row whose score reaches it has a partial
   score of at least cutoff / parts in some part, so each node gives all its
   entries from that threshold on. Entries that can't reach the cutoff even
   if each unseen part lies just below the threshold are dropped.
3. The remaining candidates are scored in full, and the ``k`` best stay.

Queries meet vectors in blocks of bounded size, one pair of blocks per row.
The parts of a pair of blocks are in one row, so phases 2 and 3 are one pass
over the pairs that gives only rows whose full score reaches the cutoff: their
number follows the number of queries, not that of pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import land

SCALE, K, PARTS = 64, 20, 2
QUERY_BLOCK, VECTOR_BLOCK = 512, 4096
_BLOCK = "dim int, block long, ids binary, data binary"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with floor(scale * x) per component. Vectors that are
    null, or hold a null or non-finite component, and rows without an id take
    no part; rows that repeat an id and its vector count as one."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
        .select("vec_id", F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e).cast("long")).alias("v"))
        .distinct()
    )


def _pack_block(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    ids = pdf["vec_id"].to_numpy(np.int64)
    data = np.array(pdf["v"].to_list(), np.int64).reshape(len(pdf), int(key[0]))
    return pd.DataFrame({"dim": [int(key[0])], "block": [int(key[1])], "ids": [ids.tobytes()], "data": [data.tobytes()]})


def blocks(vectors: DataFrame, size: int, name: str) -> tuple[DataFrame, dict[int, int]]:
    """Blocks of about ``size`` vectors of equal dimension, and the number of
    blocks by dimension (vectors of different dimension have no score)."""
    counts = vectors.groupBy(F.size("v").alias("dim")).count()
    n = {r["dim"]: -(-r["count"] // size) for r in counts.collect()}  # a row per dimension
    number = F.lit(1).cast("long")
    for dim, c in n.items():
        number = F.when(F.size("v") == dim, F.lit(c).cast("long")).otherwise(number)
    keyed = vectors.withColumn("dim", F.size("v")).withColumn("block", F.pmod(F.xxhash64("vec_id"), number))
    return land(keyed.groupBy("dim", "block").applyInPandas(_pack_block, _BLOCK), name), n


def _matrix(r: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one side of a block pair."""
    ids = np.frombuffer(r[f"{side}_ids"], np.int64)
    return ids, np.frombuffer(r[f"{side}_data"], np.int64).reshape(len(ids), r["dim"])


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point only where every sum stays
    below 2**53."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return q @ v.T


def _cuts(dim: int, parts: int) -> list[slice]:
    edges = np.linspace(0, dim, parts + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


_ENTRY = "dim int, q_block long, v_block long, q int, v int, part int, partial long"


def _entries(out) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    cols = [np.concatenate(c) for c in zip(*out)] if out else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in _ENTRY.split(", ")])


def _local_lists(parts: int, k: int):
    """Phase 1: each node's highest partial scores."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                dim, out = r["dim"], []
                (q_ids, q), (v_ids, v) = _matrix(r, "q"), _matrix(r, "v")
                own = q_ids[:, None] == v_ids[None, :]
                for p, cut in enumerate(_cuts(dim, parts)):
                    score = _product(q[:, cut], v[:, cut])
                    score[own] = np.iinfo(np.int64).min
                    n = min(k, score.shape[1])
                    at = np.argpartition(score, score.shape[1] - n, axis=1)[:, score.shape[1] - n :]
                    qi, vi = np.repeat(np.arange(len(q)), n), at.ravel()
                    ok = ~own[qi, vi]
                    qi, vi = qi[ok], vi[ok]
                    m = len(qi)
                    out.append((np.full(m, dim), np.full(m, r["q_block"]), np.full(m, r["v_block"]), qi, vi, np.full(m, p), score[qi, vi]))
                yield _entries(out)

    return run


def _full_scores(q: np.ndarray, v: np.ndarray, qi: np.ndarray, vi: np.ndarray) -> np.ndarray:
    score = np.empty(len(qi), np.int64)
    for at in range(0, len(qi), 65536):
        score[at : at + 65536] = np.einsum("ij,ij->i", q[qi[at : at + 65536]], v[vi[at : at + 65536]])
    return score


def _reaching(parts: int):
    """Phases 2 and 3 of a block pair: the entries from the threshold on,
    without those that can't reach the cutoff, scored in full. Without a
    cutoff, all of them."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                (q_ids, q), (v_ids, v) = _matrix(r, "q"), _matrix(r, "v")
                cutoff, none = np.frombuffer(r["cutoffs"], np.int64), np.iinfo(np.int64).min
                least = np.where(cutoff == none, none, -(-cutoff // parts))[:, None]
                able = np.zeros((len(q), len(v)), bool)
                most = np.zeros((len(q), len(v)), np.int64)
                for cut in _cuts(r["dim"], parts):
                    partial = _product(q[:, cut], v[:, cut])
                    seen = partial >= least
                    able |= seen
                    most += np.where(seen, partial, least - 1)
                able &= (most >= cutoff[:, None]) & (q_ids[:, None] != v_ids[None, :])
                qi, vi = np.nonzero(able)
                score = _full_scores(q, v, qi, vi)
                ok = score >= cutoff[qi]
                yield _scored(r, q_ids, v_ids, qi[ok], vi[ok], score[ok])

    return run


def _resolve(batches):
    """Full scores of the listed pairs of a block pair."""
    for b in batches:
        for r in b.to_pylist():
            (q_ids, q), (v_ids, v) = _matrix(r, "q"), _matrix(r, "v")
            pairs = np.array([(x["q"], x["v"]) for x in r["pairs"]], np.int64).reshape(-1, 2)
            yield _scored(r, q_ids, v_ids, pairs[:, 0], pairs[:, 1], _full_scores(q, v, pairs[:, 0], pairs[:, 1]))


def _scored(r: dict, q_ids: np.ndarray, v_ids: np.ndarray, qi: np.ndarray, vi: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(qi), r["dim"]), pa.int32()),
            pa.array(np.full(len(qi), r["q_block"]), pa.int64()),
            pa.array(qi, pa.int32()),
            pa.array(q_ids[qi], pa.int64()),
            pa.array(v_ids[vi], pa.int64()),
            pa.array(score, pa.int64()),
        ],
        names=["dim", "q_block", "q", "query_id", "vec_id", "score"],
    )


_SCORED = "dim int, q_block long, q int, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, k: int = K, every: int = 20, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """The ``k`` highest scores of every query (a row whose vec_id is
    divisible by ``every``) among all other rows: query_id, rank, vec_id,
    score; ties go to the smaller vec_id, and a query with fewer candidates
    lists them all. Rows with the query's own id are no candidates. Vectors
    of another dimension than the query's have no score. Of equal vectors
    only the k + 1 with the smallest ids can be listed, so the others are left
    out of the search; as queries they all take part. An empty table gives no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    whole = land(integer_vectors(vectors, scale), "topk-vectors")
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    listed = land(whole.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy"), "topk-listed")
    v_blocks, nv = blocks(listed, VECTOR_BLOCK, "topk-vector-blocks")
    q_blocks, nq = blocks(whole.where(F.col("vec_id") % every == 0), QUERY_BLOCK, "topk-query-blocks")
    grid = [(d, q) for d in nq if d in nv for q in range(nq[d])]
    if not grid:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def renamed(df, side):
        return df.select("dim", F.col("block").alias(f"{side}_block"), F.col("ids").alias(f"{side}_ids"), F.col("data").alias(f"{side}_data"))

    queries, data = renamed(q_blocks, "q"), renamed(v_blocks, "v")
    width = F.lit(0).cast("long")
    for d, n in nq.items():
        width = F.when(F.col("dim") == d, F.lit(n).cast("long")).otherwise(width)
    dealt = data.where(width > 0).withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), width - 1)))
    tasks = max(1, min(len(grid) * max(nv.values()), int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))

    def met(queries):
        return dealt.join(queries, ["dim", "q_block"]).repartition(tasks, "dim", "q_block", "v_block")

    def resolved(pairs):
        lists = pairs.groupBy("dim", "q_block", "v_block").agg(F.collect_list(F.struct("q", "v")).alias("pairs"))
        rows = lists.join(queries, ["dim", "q_block"]).join(data, ["dim", "v_block"])
        return rows.mapInArrow(_resolve, _SCORED)

    best = Window.partitionBy("dim", "q_block", "q").orderBy(F.desc("score"), "vec_id")
    # Phase 1: local lists, and from them a safe cutoff per query.
    named = land(met(queries).mapInArrow(_local_lists(parts, k), _ENTRY), "topk-local")
    of_part = Window.partitionBy("dim", "q_block", "q", "part").orderBy(F.desc("partial"))
    named = named.withColumn("r", F.row_number().over(of_part)).where(F.col("r") <= k).select("dim", "q_block", "v_block", "q", "v").distinct()
    kth = land(
        resolved(named).withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("dim", "q_block", "q", F.col("score").alias("cutoff")),
        "topk-cutoffs",
    )
    # Phases 2 and 3: entries from cutoff / parts on, and the full scores of those that can reach the cutoff.
    reach = kth.groupBy("dim", "q_block").agg(F.collect_list(F.struct("q", "cutoff")).alias("cuts"))
    bounded = queries.join(reach, ["dim", "q_block"], "left").mapInArrow(
        _cutoffs, "dim int, q_block long, q_ids binary, q_data binary, cutoffs binary"
    )
    scored = land(met(bounded).mapInArrow(_reaching(parts), _SCORED), "topk-reaching")
    return (
        scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _cutoffs(batches):
    """Adds to each query block the cutoff of each query; the least integer
    where there is none."""
    for b in batches:
        cutoffs = []
        for r in b.to_pylist():
            x = np.full(len(r["q_ids"]) // 8, np.iinfo(np.int64).min)
            for c in r["cuts"] or []:
                x[c["q"]] = c["cutoff"]
            cutoffs.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(cutoffs, pa.binary())], names=[*b.schema.names[:4], "cutoffs"])
