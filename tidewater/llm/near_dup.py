"""MinHash near-dedup by tensored banding (operator 8).

A document's set holds the distinct ``words``-word shingles of its whole
text. ``halves`` half keys are computed per set, each from ``hashes``
minhashes; a table key joins a pair of half keys. So ``halves * (halves - 1)
/ 2`` tables of ``2 * hashes`` minhashes each cost only ``halves * hashes``
minhash computations. With the defaults (40 x 6: 780 tables from 240 hashes) a
pair at similarity 0.8 shares no table with probability 8e-5, and one at 0.85
with 1e-7.

Equal sets are collapsed to one numbered class before anything else, and
buckets of different tables that hold the same classes to one bucket.
Candidates come from buckets and are confirmed on full sets:

1. each class is compared with one hub of its buckets, then with up to HUBS
   more that are in other components; links are grouped into components. The
   hub of a bucket is the class whose half keys most classes share, which is
   the middle of a group of near copies;
2. of a small bucket that still holds several components, all pairs across
   components are candidates. An exact bound on the overlap, from bitmaps of
   the sets, discards pairs that can't be links before the full check;
3. large buckets that still hold several components are worked through by the
   rarer one of their two half keys: a group of near copies shares hundreds of
   buckets, but at most ``halves`` half keys. All classes with such a half key
   are one bucket, worked through in rounds. A round takes up to PIVOTS of its
   classes, those of its smallest components first and none of its largest
   one, and compares all its other classes with them, in chunks: first a
   spanning forest of the components is proposed, then every pair that is
   still open. The pivots are done then, and leave the bucket. Rounds end
   when what is left of every bucket is one component.

A round copies a class a bounded number of times. No step emits all pairs of a
bucket that already is one component, and a bucket is never cut or dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import components, land

WORDS, SIMILARITY = 5, 80  # words of a shingle; least similarity in per cent
HALVES, HASHES, HUBS = 40, 6, 4
SMALL = 16  # members of a bucket whose pairs are listed
PIVOTS = 512  # members of a bucket that a round compares with all others
CHUNK = 1024  # members of a bucket that are compared with its pivots at a time
BITMAP_WORDS = 32  # 64-bit words of the bitmap that bounds an overlap
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = np.random.default_rng(20240607).integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = np.random.default_rng(20240608).integers(0, 2**32, 4096, dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit ids of a text's shingles; with fewer words than
    ``words`` the whole sequence is one shingle; empty without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix(out * _ODD[0] + ids[i : len(ids) - width + 1 + i])
    return np.unique(out)


def half_keys(ids: np.ndarray, halves: int, hashes: int) -> np.ndarray:
    """``halves`` keys, each of ``hashes`` 32-bit minhashes; empty for an
    empty set. The ids are hashes already, so a keyed product orders them."""
    if not len(ids):
        return np.empty(0, np.int64)
    x = (ids >> np.uint64(32)).astype(np.uint32)
    least = np.full(halves * hashes, np.iinfo(np.uint32).max, np.uint32)
    flip, by = _KEYS[: halves * hashes], _KEYS[2048 : 2048 + halves * hashes] | np.uint32(1)
    for at in range(0, len(x), 2048):
        np.minimum(least, ((x[at : at + 2048, None] ^ flip) * by).min(axis=0), out=least)
    rows = np.ascontiguousarray(least.reshape(halves, hashes))
    return np.array([xxhash.xxh3_64_intdigest(r.tobytes(), seed=i) for i, r in enumerate(rows)], np.uint64).view(np.int64)


def bitmap(ids: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP_WORDS * 64, np.uint8)
    bits[(ids % np.uint64(BITMAP_WORDS * 64)).astype(np.int64)] = 1
    return np.packbits(bits)


def _signatures(words: int, halves: int, hashes: int):
    def run(batches):
        for b in batches:
            n, digest, keys = [], [], []
            for text in b.column(2).to_pylist():
                s = shingles(text, words)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(half_keys(s, halves, hashes))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "code", "n", "digest", "halves"],
            )

    return run


def _full_sets(words: int):
    def run(batches):
        for b in batches:
            rows = [shingles(t, words) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in rows], pa.binary()),
                    pa.array([len(s) for s in rows], pa.int64()),
                    pa.array([s.tobytes() for s in rows], pa.binary()),
                    pa.array([bitmap(s).tobytes() for s in rows], pa.binary()),
                ],
                names=["digest", "n", "ids", "bits"],
            )

    return run


def _confirm(similarity: int):
    def run(batches):
        for b in batches:
            left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
            ok = []
            for x, y in zip(left, right):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum())
                ok.append(100 * common >= similarity * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def confirm(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those pairs ``(a, b)`` whose full sets are similar enough. Pairs and
    their classes are landed, so that few pairs move few sets."""
    pairs = land(pairs, "near-pairs")
    if pairs.isEmpty():
        return pairs
    wanted = land(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "near-wanted")
    sets = sets.join(wanted, "cls", "left_semi")
    ids = lambda at: sets.select(F.col("cls").alias(at), F.col("ids").alias(f"ids_{at}"))
    # Hubs are in ``a``: members' sets are brought to theirs, not theirs copied.
    return (
        pairs.join(ids("b"), "b").join(ids("a"), "a").select("a", "b", "ids_a", "ids_b")
        .mapInArrow(_confirm(similarity), "a long, b long")
    )


def _bounded(similarity: int):
    """Drops pairs whose bitmaps rule out a link: each bit that only one set
    has stands for at least one element that the other lacks."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n = [b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
            bits = [np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint64).reshape(-1, BITMAP_WORDS) for i in (4, 5)]
            both = np.bitwise_count(bits[0] & bits[1]).sum(axis=1, dtype=np.int64)
            most = np.minimum(*(m - np.bitwise_count(x).sum(axis=1, dtype=np.int64) + both for m, x in zip(n, bits)))
            ok = 100 * most >= similarity * (n[0] + n[1] - most)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _listed_pairs(open_rows: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Distinct possible pairs of different components in small buckets."""
    held = open_rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("cls", "label"))).alias("held"))
    pairs = F.flatten(
        F.transform(
            "held",
            lambda x: F.transform(
                F.filter("held", lambda y: (y["cls"] > x["cls"]) & (y["label"] != x["label"])),
                lambda y: F.struct(x["cls"].alias("a"), y["cls"].alias("b")),
            ),
        )
    )
    return _possible(held.select(F.explode(pairs).alias("p")).select("p.*").distinct(), sets, similarity)


def _possible(listed: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``(a, b)`` without those that sizes or bitmaps rule out."""
    n = lambda at: sets.select(F.col("cls").alias(at), F.col("n").alias(f"n_{at}"), F.col("bits").alias(f"bits_{at}"))
    fits = 100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")
    return (
        listed.join(n("b"), "b").join(n("a"), "a").where(fits).select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        .mapInArrow(_bounded(similarity), "a long, b long")
    )


def _propose(similarity: int, forest: bool):
    """For one chunk of a bucket and the bucket's pivots: pairs of different
    components that may be links; with ``forest`` the likeliest of them that
    join all components they can."""

    def run(pdf):
        import pandas as pd

        # A pivot is also a member, of one of the chunks.
        n, cls = pdf["n"].to_numpy(), pdf["cls"].to_numpy()
        label = pd.factorize(pdf["label"])[0]
        pivots = np.flatnonzero(pdf["pivot"].to_numpy())
        js = np.flatnonzero(~pdf["pivot"].to_numpy())
        again = np.isin(cls, cls[pivots])
        bits = np.frombuffer(b"".join(pdf["bits"]), np.uint64).reshape(len(pdf), BITMAP_WORDS)
        count = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        left, right, bound = [], [], []
        for i in pivots:
            ok = (label[js] != label[i]) & (100 * np.minimum(n[js], n[i]) >= similarity * np.maximum(n[js], n[i]))
            ok &= ~again[js] | (cls[js] > cls[i])  # two pivots are compared once
            to = js[ok]
            both = np.bitwise_count(bits[to] & bits[i]).sum(axis=1, dtype=np.int64)
            most = np.minimum(n[i] - count[i] + both, n[to] - count[to] + both)
            ok = 100 * most >= similarity * (n[i] + n[to] - most)
            to, most = to[ok], most[ok]
            left.append(np.full(len(to), i))
            right.append(to)
            bound.append(most / (n[i] + n[to] - most))
        if not left or not len(js):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        left, right, bound = map(np.concatenate, (left, right, bound))
        if forest:
            root = list(range(label.max() + 1))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            chosen = []
            for k in np.argsort(-bound, kind="stable"):
                x, y = find(label[left[k]]), find(label[right[k]])
                if x != y:
                    root[x] = y
                    chosen.append(k)
            left, right = left[chosen], right[chosen]
        return pd.DataFrame({"a": cls[left], "b": cls[right]})

    return run


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: int = SIMILARITY,
    halves: int = HALVES,
    hashes: int = HASHES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are what stands between ASCII white space after lower-casing A-Z.
    Two rows are linked when ``100 * common >= similarity * union`` holds for
    their shingle sets; ``component_id`` is the smallest id reachable over
    links (null ids are never the smallest unless all are null), ``kept``
    marks the rows that carry it. Null and empty texts have an empty set, are
    linked with nothing and kept. Rows with equal sets, repeated rows among
    them, are one class. An empty table gives no rows; other columns are
    ignored.
    """
    id_ = F.col(id_col).cast("long")
    rows = docs.select(id_.alias("row"), id_.alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labelled = _labelled(rows, words, similarity, halves, hashes)
    least = land(labelled.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "near-least")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return labelled.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(
    docs: DataFrame,
    words: int = WORDS,
    similarity: int = SIMILARITY,
    halves: int = HALVES,
    hashes: int = HASHES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs``, all columns, with one row of each component: the one with the
    smallest id (null ids come last), and of rows that share it, or have none,
    the first. Rows with an empty set all stay.

    Rows are told apart by a number that is landed with them, so null and
    repeated ids neither lose nor bring back a row.
    """
    keyed = land(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    rows = keyed.select(
        F.col("__row").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    labelled = _labelled(rows, words, similarity, halves, hashes)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = labelled.where("n > 0").groupBy("label").agg(F.min(order).alias("first")).select("first.row")
    # The rows that go are far fewer than those that stay, so the texts seldom have to be moved to them.
    gone = land(labelled.where("n > 0").select("row").join(first, "row", "left_anti"), "near-gone")
    return keyed.join(gone, keyed["__row"] == gone["row"], "left_anti").select(docs.columns)


def _labelled(rows: DataFrame, words: int, similarity: int, halves: int, hashes: int) -> DataFrame:
    """``(row, doc_id, n, label)`` of rows ``(row, doc_id, text)``: the size of
    the set, and the component (null for an empty set). ``row`` and a hash of
    the text lead back to the texts; rows that share both are read together."""
    rows = rows.select("row", "doc_id", "text", F.xxhash64("text").alias("code"))
    sig = land(
        rows.mapInArrow(
            _signatures(words, halves, hashes),
            "row long, doc_id long, code long, n long, digest binary, halves array<long>",
        ),
        "near-signatures",
    )
    classes = land(
        sig.where("n > 0").groupBy("digest")
        .agg(F.first("halves").alias("halves"), F.min(F.struct("row", "code")).alias("text"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "near-classes",
    )
    alive = _alive(classes)
    members = land(_members(alive), "near-members")
    needed = land(
        classes.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", "digest", "text.row", "text.code"),
        "near-needed",
    )
    wanted = rows["row"].eqNullSafe(needed["row"]) & (rows["code"] == needed["code"])
    sets = land(
        rows.join(needed, wanted, "left_semi").select("text")
        .mapInArrow(_full_sets(words), "digest binary, n long, ids binary, bits binary")
        .join(needed.select("cls", "digest"), "digest")
        .dropDuplicates(["digest"])  # sets are where the join has brought them
        .drop("digest"),
        "near-sets",
    )

    near = F.struct("c", "hub")
    stars = land(members.where("cls <> hub").groupBy("cls", "hub").agg(F.sum("tables").alias("c")), "near-stars")
    first = stars.groupBy("cls").agg(F.max_by("hub", near).alias("hub"))
    links = land(confirm(first.select(F.col("hub").alias("a"), F.col("cls").alias("b")), sets, similarity), "near-links")
    comp = land(components(links, "near"), "near-components")
    of = lambda at: comp.select(F.col("node").alias(at), F.col("component").alias(f"{at}_label"))
    apart = stars.join(of("cls"), "cls", "left").join(of("hub"), "hub", "left").where(
        F.coalesce("cls_label", "cls") != F.coalesce("hub_label", "hub")
    )
    nearest = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("c"), "hub"))
    more = apart.withColumn("r", nearest).where(F.col("r") <= HUBS).select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    comp = _merged(comp, land(confirm(_possible(more, sets, similarity), sets, similarity), "near-links"))
    tagged = _tagged(members, comp)
    still = land(_several(tagged.where(F.col("size") <= SMALL)), "near-open")
    found = _listed_pairs(tagged.join(still.select("key"), "key", "left_semi"), sets, similarity)
    comp = _merged(comp, land(confirm(found, sets, similarity), "near-links"))
    still = land(_several(tagged.where(F.col("size") > SMALL)), "near-open")
    if not still.isEmpty():
        comp = _rounds(_homes(alive, still, sets), comp, sets, similarity)

    labelled = sig.join(classes.select("digest", "cls"), "digest", "left").join(
        comp.withColumnRenamed("node", "cls"), "cls", "left"
    )
    return land(labelled.select("row", "doc_id", "n", F.coalesce("component", "cls").alias("label")), "near-labelled")


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return comp
    joined = comp.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return land(components(joined.union(links), "near"), "near-components")


def _alive(classes: DataFrame) -> DataFrame:
    """``(cls, hs, common)`` of classes with at least two half keys that other
    classes share: those half keys ``(i, h, c)``, each with the number of
    classes that have it, and the sum of these numbers."""
    half = classes.select("cls", F.posexplode("halves").alias("i", "h"))
    shared = land(half.groupBy("i", "h").agg(F.count("*").alias("c")).where("c > 1"), "near-half-keys")
    return land(
        half.join(shared, ["i", "h"]).groupBy("cls")
        .agg(F.array_sort(F.collect_list(F.struct("i", "h", "c"))).alias("hs"), F.sum("c").alias("common"))
        .where("size(hs) > 1"),
        "near-alive",
    )


def _tables(of) -> Column:
    """What ``of`` gives of every pair of the half keys in ``hs``."""
    return F.flatten(
        F.transform("hs", lambda x: F.transform(F.filter("hs", lambda y: y["i"] > x["i"]), lambda y: of(x, y)))
    )


def _table_key(x: Column, y: Column) -> Column:
    return F.xxhash64(x["i"], x["h"], y["i"], y["h"])


def _members(alive: DataFrame) -> DataFrame:
    """``(key, cls, hub, size, tables)`` of every bucket with at least two
    classes; buckets that hold the same classes are one, and ``tables`` says
    of how many. Pairs are formed from half keys that at least two classes
    share; no other table key can have two members."""
    keyed = alive.select("cls", "common", F.explode(_tables(_table_key)).alias("key"))
    # Two 64-bit hashes, the size and the hub stand for the classes of a bucket.
    buckets = keyed.groupBy("key").agg(
        F.max(F.struct("common", "cls")).alias("top"),
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("cls")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("two"),
    )
    distinct = land(
        buckets.where("size > 1").groupBy("top", "size", "one", "two")
        .agg(F.min("key").alias("key"), F.count("*").alias("tables"))
        .select("key", F.col("top.cls").alias("hub"), "size", "tables"),
        "near-buckets",
    )
    return keyed.select("key", "cls").join(distinct, "key")


def _homes(alive: DataFrame, still: DataFrame, sets: DataFrame) -> DataFrame:
    """``(key, cls, size)`` of buckets by half key that hold all classes of the
    buckets ``(key, hub)``: each is held by the rarer one of its half keys."""
    half = lambda x: F.struct(x["c"].alias("c"), x["i"].alias("i"), x["h"].alias("h"))
    home = lambda x, y: F.struct(_table_key(x, y).alias("key"), F.least(half(x), half(y)).alias("home"))
    hubs = alive.join(still.select(F.col("hub").alias("cls")).distinct(), "cls", "left_semi")
    homes = (
        hubs.select(F.col("cls").alias("hub"), F.explode(_tables(home)).alias("t")).select("hub", "t.*")
        .join(still, ["key", "hub"], "left_semi").select("home.i", "home.h").distinct()
    )
    rows = alive.join(sets.select("cls"), "cls", "left_semi").select("cls", F.inline("hs"))
    held = rows.join(land(homes, "near-homes"), ["i", "h"], "left_semi")
    return land(held.select(F.xxhash64("i", "h").alias("key"), "cls", F.col("c").alias("size")), "near-held")


def _tagged(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members with their components as ``label``."""
    labels = comp.select(F.col("node").alias("cls"), "component")
    return land(
        members.join(labels, "cls", "left").withColumn("label", F.coalesce("component", "cls")).drop("component"), "near-tagged"
    )


def _several(tagged: DataFrame) -> DataFrame:
    """``(key, hub)`` of the buckets that hold at least two components."""
    return (
        tagged.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("hub").alias("hub"))
        .where("x <> y").select("key", "hub")
    )


def _open(members: DataFrame, comp: DataFrame) -> DataFrame | None:
    """Those members, with their components as ``label``, whose bucket holds
    at least two components; None when there is no such bucket."""
    tagged = _tagged(members, comp)
    still = land(tagged.join(_several(tagged.withColumn("hub", F.col("cls"))).select("key"), "key", "left_semi"), "near-open")
    return None if still.isEmpty() else still


def _rounds(members: DataFrame, comp: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Components after all pairs across components of large buckets were
    compared, by rounds of pivots."""
    info = sets.select("cls", "n", "bits")
    while (still := _open(members, comp)) is not None:
        # Classes of the smallest components first. The largest one of a bucket has no pivots: all its pairs with
        # other components are pairs with their classes. Only components that a round reaches meet their members.
        sizes = still.groupBy("key", "label").agg(F.count("*").alias("held"))
        of_key = Window.partitionBy("key").orderBy("held", "label")
        reached = (
            sizes.withColumn("before", F.sum("held").over(of_key) - F.col("held"))
            .withColumn("rank", F.row_number().over(of_key))
            .withColumn("last", F.max("rank").over(Window.partitionBy("key")))
            .where((F.col("before") < PIVOTS) & (F.col("rank") < F.col("last")))
        )
        reached = land(reached.select("key", "label", "before"), "near-reached")
        order = F.row_number().over(Window.partitionBy("key", "label").orderBy("cls"))
        pivots = land(
            still.join(reached, ["key", "label"]).withColumn("place", order).where(F.col("before") + F.col("place") <= PIVOTS)
            .select("key", "cls", "size"),
            "near-pivots",
        )
        chunks = F.ceil(F.col("size") / CHUNK)
        dealt = land(
            still.select("key", "cls", F.pmod(F.xxhash64("cls"), chunks).alias("chunk"), F.lit(False).alias("pivot"))
            .union(
                pivots.select("key", "cls", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), F.lit(True))
            )
            .join(info, "cls"),
            "near-dealt",
        )
        for forest in (True, False):
            labels = comp.withColumnRenamed("node", "cls")
            found = (
                dealt.join(labels, "cls", "left").withColumn("label", F.coalesce("component", "cls"))
                .groupBy("key", "chunk").applyInPandas(_propose(similarity, forest), "a long, b long")
                .distinct()
            )
            comp = _merged(comp, land(confirm(found, sets, similarity), "near-links"))
        # Members that were pivots are done in their bucket.
        members = land(still.drop("label").join(pivots.select("key", "cls"), ["key", "cls"], "left_anti"), "near-left")
    return comp
