"""Best-fit packing by a grouping genetic algorithm on islands (operator 10).

Documents become token pieces of at most ``size`` tokens. Pieces that fill a
sequence stand alone; the others are dealt to shards of bounded size, and
each shard is packed by several islands. An island keeps a population of
packings; crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold an injected piece a second time, and puts
the displaced pieces where they fit best. After each epoch the elites of an
island migrate to the next one of the shard. The worst bins of all shards
are then pooled, dealt anew and packed once more.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import land
from tidewater.llm.tokens import encoder

SIZE = 2048
SHARD, ISLANDS, EPOCHS = 4096, 2, 2
POPULATION, GENERATIONS, ELITES = 6, 6, 2
WELL_FILLED = 0.97  # bins below this share go to the second round
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKING = "shard long, island int, bins int, score double, uids array<long>, lengths array<int>, bin array<int>"


def _cut(size: int, tokenizer: str | None):
    def run(batches):
        enc = encoder(tokenizer)
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.ids(text) + b"\0\0\0\0"
                total = len(ids) // 4
                first = total % size or size
                start, piece = 0, 0
                while start < total:
                    n = first if piece == 0 else size
                    out.append((uid, doc_id, piece, start, n, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])))
                    start, piece, uid = start + n, piece + 1, uid + 1
            cols = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per token piece: a document's ids, then id 0; only documents
    longer than ``size`` are cut, and only the first piece may be shorter."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _cut(size, tokenizer), PIECES
    )


class Packing:
    """An assignment of pieces to bins: lists of piece numbers, and their fills."""

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill
        self._key = len(bins), -float(sum(f * f for f in fill))

    def key(self) -> tuple[int, float]:
        """Smaller is better: fewer bins, then fuller ones."""
        return self._key


def best_fit(bins: list[list[int]], fill: list[int], items: list[int], lengths: list[int], size: int) -> None:
    """Put each of ``items``, in the given order, into the fullest bin that
    still takes it, or into a new one."""
    free = sorted((size - f, i) for i, f in enumerate(fill) if f < size)
    for x in items:
        n = lengths[x]
        at = bisect_left(free, (n, -1))
        if at < len(free):
            space, i = free.pop(at)
            bins[i].append(x)
            fill[i] += n
        else:
            space, i = size, len(bins)
            bins.append([x])
            fill.append(n)
        if space > n:
            insort(free, (space - n, i))


def crossover(a: Packing, b: Packing, lengths: list[int], size: int, rng) -> Packing:
    """Whole well-filled bins of ``b`` go into ``a``."""
    order = np.argsort(-np.array(b.fill), kind="stable")[: max(1, len(b.bins) // 2)]
    chosen = rng.choice(order, max(1, len(order) // 3), replace=False).tolist()
    inside = {x for i in chosen for x in b.bins[i]}
    bins, fill, displaced = [], [], []
    for g, f in zip(a.bins, a.fill):
        if inside.isdisjoint(g):
            bins.append(list(g))
            fill.append(f)
        else:
            displaced += [x for x in g if x not in inside]
    bins += [list(b.bins[i]) for i in chosen]
    fill += [b.fill[i] for i in chosen]
    return _finish(bins, fill, displaced, lengths, size)


def mutate(a: Packing, lengths: list[int], size: int, rng) -> Packing:
    """Empty the worst bins and some others, and place their pieces anew."""
    order = np.argsort(a.fill, kind="stable")
    few = max(1, len(order) // 50)
    gone = set(order[:few].tolist()) | set(rng.choice(len(order), few).tolist())
    stay = [i for i in range(len(a.bins)) if i not in gone]
    displaced = [x for i in sorted(gone) for x in a.bins[i]]
    return _finish([list(a.bins[i]) for i in stay], [a.fill[i] for i in stay], displaced, lengths, size)


def _finish(bins, fill, displaced, lengths, size) -> Packing:
    displaced.sort(key=lambda x: -lengths[x])
    best_fit(bins, fill, displaced, lengths, size)
    return Packing(bins, fill)


def first_packing(lengths: list[int], size: int, rng, noise: float) -> Packing:
    order = np.argsort(-np.array(lengths) * (1 + noise * rng.random(len(lengths))), kind="stable")
    bins: list[list[int]] = []
    fill: list[int] = []
    best_fit(bins, fill, order.tolist(), lengths, size)
    return Packing(bins, fill)


def evolve(population: list[Packing], lengths: list[int], size: int, rng) -> list[Packing]:
    while len(population) < POPULATION:
        population.append(first_packing(lengths, size, rng, 0.3 * len(population) / POPULATION))
    population.sort(key=Packing.key)
    least = -(-sum(lengths) // size)
    for _ in range(GENERATIONS):
        if len(population[0].bins) <= least:
            break
        young = []
        for _ in range(POPULATION // 2):
            i, j = sorted(rng.choice(len(population), 2, replace=False))
            young.append(crossover(population[j], population[i], lengths, size, rng))
        young.append(mutate(population[0], lengths, size, rng))
        population = sorted(population + young, key=Packing.key)[:POPULATION]
    return population


def _island(size: int, seed: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        rng = np.random.default_rng([seed, shard & 0x7FFFFFFF, island])
        if "uids" in pdf:  # elites, of this island and of the one before
            uids = np.asarray(pdf["uids"].iloc[0], np.int64)
            lengths = np.asarray(pdf["lengths"].iloc[0]).tolist()
            population = []
            for r_uids, r_bin in zip(pdf["uids"], pdf["bin"]):
                of = dict(zip(r_uids, r_bin))
                groups: dict[int, list[int]] = {}
                for x, u in enumerate(uids.tolist()):
                    groups.setdefault(of[u], []).append(x)
                bins = [groups[b] for b in sorted(groups)]
                population.append(Packing(bins, [sum(lengths[x] for x in g) for g in bins]))
        else:
            pdf = pdf.sort_values("uid")
            uids, lengths, population = pdf["uid"].to_numpy(np.int64), pdf["length"].tolist(), []
        rows = []
        for p in evolve(population, lengths, size, rng)[:ELITES]:
            bin_of = np.empty(len(uids), np.int64)
            for i, g in enumerate(p.bins):
                bin_of[g] = i
            rows.append((shard, island, len(p.bins), p.key()[1], uids.tolist(), lengths, bin_of.tolist()))
        return pd.DataFrame(rows, columns=["shard", "island", "bins", "score", "uids", "lengths", "bin"])

    return run


def pack_items(items: DataFrame, size: int, name: str, seed: int = 7) -> DataFrame:
    """Bins of ``items`` (uid, length below ``size``): uid, length, shard, bin."""
    n = items.count()
    shards = max(1, -(-n // SHARD))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards).cast("long")))
    islands = dealt.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    state = land(islands.groupBy("shard", "island").applyInPandas(_island(size, seed), PACKING), f"{name}-epoch-0")
    for epoch in range(1, EPOCHS):
        arrived = state.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        state = land(
            state.union(arrived).groupBy("shard", "island").applyInPandas(_island(size, seed + epoch), PACKING),
            f"{name}-epoch-{epoch}",
        )
    best = state.groupBy("shard").agg(F.min_by(F.struct("uids", "lengths", "bin"), F.struct("bins", "score", "island")).alias("b"))
    return best.select("shard", F.explode(F.arrays_zip("b.uids", "b.lengths", "b.bin")).alias("x")).select(
        F.col("x.uids").alias("uid"), F.col("x.lengths").cast("long").alias("length"), "shard", F.col("x.bin").alias("bin")
    )


def pack(
    docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    Null and empty texts are one piece of the closing id 0 alone. Rows that
    repeat an id are packed one by one; null ids stay null. Sequence numbers
    are unique but not dense. An empty table gives no rows; other columns
    are ignored.
    """
    all_pieces = land(pieces(docs, size, tokenizer, id_col, text_col), "pack-pieces")
    items = all_pieces.where(F.col("length") < size).select("uid", "length")
    first = land(pack_items(items, size, "pack-first"), "pack-bins")
    fills = first.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
    loose = land(
        first.join(fills.where(F.col("fill") < WELL_FILLED * size).select("shard", "bin"), ["shard", "bin"]).select("uid", "length", "shard", "bin"),
        "pack-loose",
    )
    again = land(pack_items(loose.select("uid", "length"), size, "pack-second", seed=11), "pack-second-bins")
    before, after = (x.select("shard", "bin").distinct().count() for x in (loose, again))
    if after < before:
        firm = first.join(loose.select("uid"), "uid", "left_anti")
        packed = firm.withColumn("round", F.lit(1)).unionByName(again.withColumn("round", F.lit(2)))
    else:
        packed = first.withColumn("round", F.lit(1))
    placed = packed.groupBy("round", "shard", "bin").agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("held"))
    # A bin holds at most ``size`` pieces; its smallest piece numbers the sequence.
    placed = placed.select(
        (F.col("held")[0]["uid"] * 2).alias("sequence_id"), F.posexplode("held").alias("k", "x"), "held"
    ).select(
        F.col("x.uid").alias("uid"),
        "sequence_id",
        F.aggregate(F.slice("held", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda s, h: s + h["length"]).alias("offset"),
    )
    return all_pieces.join(land(placed, "pack-placed"), "uid", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("sequence_id", F.col("uid") * 2 + 1).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )
