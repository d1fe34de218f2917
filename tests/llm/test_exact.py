"""Exact dedup, line dedup, near-dedup, WARC, top-k against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tidewater.llm import line_dedup, near_dup, stream_dedup, topk, warc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CASES = [
    (1, "A b"), (2, "a B"), (3, "a b"), (3, "a b"), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "a b"),
    (8, "x" * 300_000), (9, "X" * 300_000), (10, "line\nline"),
]


def test_stream_dedup(docs_of):
    got = stream_dedup.dedup_stream(docs_of(CASES)).collect()
    groups = defaultdict(list)
    for i, t in CASES:
        groups[(t or "").translate(LOW)].append(i)
    want = []
    for i, t in CASES:
        g = groups[(t or "").translate(LOW)]
        keep = max(x for x in g if x is not None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in got)


def test_stream_dedup_regroups_when_texts_differ_under_a_digest(docs_of):
    docs = docs_of([(1, "a"), (2, "A"), (3, "b")])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in stream_dedup.regrouped(docs, "doc_id", "text").collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True)}


def test_stream_dedup_finds_differing_texts(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "A"), (3, "b")])
    last = stream_dedup.fingerprints(docs).selectExpr("digest", "2L as group_size").distinct()
    assert stream_dedup.differing(docs, "doc_id", "text", last).isEmpty()


def test_stream_dedup_empty(docs_of):
    assert stream_dedup.dedup_stream(docs_of([(1, "a")]).where("false")).collect() == []


def _lines(rows, least):
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(LOW)
    seen = Counter()
    for _, t in rows:
        seen.update({key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def _line_rows(n=60):
    rng = random.Random(5)
    pool = ["Hot line", " hot LINE\t", "", "  ", "é", "a.b", "tail\r", *(f"line {i}" for i in range(25))]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8)))) for i in range(n)]
    return [*rows, (3, "Hot line\nmore"), (None, "hot line"), (900, None), (901, ""), (902, "z\n" * 50_000)]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup(docs_of, batches):
    rows = _line_rows()
    parts = [docs_of(rows[i::batches]) for i in range(batches)]
    got = line_dedup.drop_frequent_lines(docs_of(rows), min_docs=10, batches=parts, fanout=2).collect()
    assert sorted(map(str, _lines(rows, 10))) == sorted(str((r.doc_id, r.text, r.n_lines, r.n_dropped)) for r in got)
    assert got[0].kept == "x" and got[0].label == 0


def test_line_runs_are_levelled(docs_of):
    rows = _line_rows()
    runs = line_dedup.LineRuns(docs_of(rows).sparkSession, 10, fanout=2)
    shapes = []
    for k in range(4):
        runs.add_batch(docs_of(rows[k::4]))
        shapes.append([len(x) for x in runs.levels])
    assert shapes == [[1], [0, 1], [1, 1], [0, 0, 1]]


def test_line_dedup_deals_one_table_to_batches(docs_of, monkeypatch):
    """One file: every batch goes through the runs. A third of the ids is null
    and some repeat, with other texts each."""
    shapes, add = [], line_dedup.LineRuns.add_hashes

    def noted(runs, hashes):
        add(runs, hashes)
        shapes.append(([len(x) for x in runs.levels], runs.frequent is not None))

    monkeypatch.setattr(line_dedup.LineRuns, "add_hashes", noted)
    rows = [(None if k % 3 == 0 else 7 if k % 5 == 0 else i, t) for k, (i, t) in enumerate(_line_rows(200))]
    got = line_dedup.drop_frequent_lines(docs_of(rows).coalesce(1), min_docs=10).collect()
    assert shapes == [([1], False), ([2], False), ([0, 1], True), ([1, 1], True)]
    assert sorted(map(str, _lines(rows, 10))) == sorted(str((r.doc_id, r.text, r.n_lines, r.n_dropped)) for r in got)


def test_line_dedup_empty_and_files(spark, docs_of, tmp_path):
    assert line_dedup.drop_frequent_lines(docs_of([(1, "a")]).where("false")).collect() == []
    rows = _line_rows()
    docs_of(rows, 4).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert len(line_dedup.split_batches(docs, 4)) == 4
    got = line_dedup.drop_frequent_lines(docs).collect()
    assert sorted(map(str, _lines(rows, 10))) == sorted(str((r.doc_id, r.text, r.n_lines, r.n_dropped)) for r in got)


def _sets(rows, words):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        n = min(words, len(w))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    return out


def _components(rows, words, least=80):
    sets, root = _sets(rows, words), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= least * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i in range(len(rows))]


def _near_rows(groups=6, size=14):
    rng = random.Random(9)
    rows, n = [], 0
    for g in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(12, 120))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 16))):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 99)}"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, t) for k, t in enumerate(["one", "ONE", "a b", "A\tB", None, "", "  \n", "a b c", "word " * 40_000])]
    return [*rows, (0, rows[0][1]), (None, rows[3][1])]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs_of, words):
    rows = _near_rows()
    got = near_dup.near_duplicates(docs_of(rows), words=words).collect()
    assert sorted(map(str, _components(rows, words))) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_stages_keep_one_row_of_each_group(spark, docs_of):
    """A third of the ids are null and some repeat: of each brute-force group
    one row stays, with the smallest id if any; rows are told apart by w."""
    import corpus_pipeline

    rows = _near_rows(groups=5)
    rows = [(None if k % 3 == 0 else 7 if k % 11 == 0 else i, t) for k, (i, t) in enumerate(rows)]
    rows += [(None, "all alone " * 9 + str(k)) for k in range(4)] + [(None, "no id at all here"), (None, "no id at all here")]
    rows += [(7, f"{k} repeated id of texts {k} that differ {k}") for k in range(4)] + [(500, "same id and text")] * 2
    shared = docs_of(rows).drop("w").collect()
    docs = spark.createDataFrame([(*r, float(k)) for k, r in enumerate(shared)], docs_of(rows).drop("w").schema.add("w", "double")).repartition(3)
    texts = [(k, r.text) for k, r in enumerate(shared)]
    groups = defaultdict(list)
    for k, n, c in _components(texts, near_dup.WORDS):
        groups[c if n else ("empty", k)].append(k)
    for stage in (corpus_pipeline.near_dedup, lambda s, d, x: corpus_pipeline.near_dedup(s, corpus_pipeline.dedup_lines(s, d, x), x)):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        kept = [int(r.w) for r in got.select("w").collect()]
        assert len(kept) == len(set(kept)) == len(groups)
        for members in groups.values():
            left = [shared[k].doc_id for k in members if k in kept]
            ids = [shared[k].doc_id for k in members if shared[k].doc_id is not None]
            assert left == [min(ids, default=None)]


def test_near_duplicates_in_small_blocks(docs_of, monkeypatch):
    """Buckets far larger than a block, with members that no hub reaches."""
    monkeypatch.setattr(near_dup, "PIVOTS", 3)
    monkeypatch.setattr(near_dup, "CHUNK", 5)
    monkeypatch.setattr(near_dup, "SMALL", 2)
    rows = _near_rows(groups=2, size=40)
    got = near_dup.near_duplicates(docs_of(rows), words=2).collect()
    assert sorted(map(str, _components(rows, 2))) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got)


def test_near_duplicates_empty(docs_of):
    assert near_dup.near_duplicates(docs_of([(1, "a")]).where("false")).collect() == []
    alone = near_dup.near_duplicates(docs_of([(1, ""), (2, None), (3, "")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in alone} == {(i, 0, i, True) for i in (1, 2, 3)}


def test_components(spark):
    from tidewater.llm.common import components

    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200), (5, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (100, 101, 103)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _pages():
    big, rng = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 70, random.Random(2)
    rows = [(1, "http://a/b c\n", big), (2, None, big), (3, "http://é", big), (3, "http://é", big), (4, "u", "s"), (5, "u", "s"),
            (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "".join(rng.choice("abcdef\r\n") for _ in range(400_000)))]
    return [(*r, 7, "x") for r in rows]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string, html string, n int, digest string").repartition(3)
    files = warc.write_warc(pages, archive_bytes=300)
    assert files.count() > 3 and sum(r.records for r in files.collect()) == len(_pages())
    chunks = warc.read_chunks(files)
    want = []
    for i, _, html, *_ in _pages():
        data = (html or "").encode()
        same = [p[0] for p in _pages() if p[2] == html]
        top = max((x for x in same if x is not None)) if len(data) >= 1000 and len(same) > 1 else None
        revisit = top is not None and i != top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in warc.read_records(chunks).collect())
    rows = sorted((r for r in chunks.collect() if r.page_id == 8), key=lambda r: r.chunk_no)
    assert [r.chunk_no for r in rows] == list(range(7)) and rows[-1].is_last
    text, done = _pages()[9][2].encode(), b""
    for r in rows:
        done += bytes(r.chunk)
        assert r.bytes_so_far == len(done) and r.digest_so_far == hashlib.sha1(done).hexdigest()
    assert done == text
    assert len({r.record_id for r in chunks.collect()}) == len(_pages())


def test_warc_is_read_by_a_plain_parser(spark):
    import gzip

    pages = spark.createDataFrame(_pages()[:1], "page_id long, url string, html string, n int, digest string")
    path = warc.write_warc(pages).first().path.removeprefix("file:")
    head, http, body = gzip.open(path).read().split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and b"WARC-Target-URI: http://a/b%20c%0A" in head
    assert http.startswith(b"HTTP/1.1 200 OK") and body == _pages()[0][2].encode() + b"\r\n\r\n"


def test_warc_empty_and_damaged(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string, html string, n int, digest string")
    assert warc.read_records(warc.read_chunks(warc.write_warc(pages.where("false")))).collect() == []
    files = warc.write_warc(pages.coalesce(1))
    path = files.first().path.removeprefix("file:")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-40])
    with pytest.raises(Exception, match="archive ends|incomplete|digest"):
        warc.read_chunks(files).collect()


def _brute_top(rows, k, every):
    ok = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
                 if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, a in ok:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
            out += [(q, r, i, -n) for r, (n, i) in enumerate(s, 1)]
    return out


@pytest.mark.parametrize("hot", [0, 90])
def test_top_k(spark, monkeypatch, hot):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(200)]
    rows += [(1000 + i, [0.5] * 9) for i in range(hot)]
    rows += [(300, None), (301, [1.0, None] * 4 + [1.0]), (302, [float("nan")] * 9), (320, [float("inf")] * 9), (340, [0.1, 0.2]),
             (360, []), (380, [-0.1, 0.2]), (None, [0.5] * 9), (7, rows[7][1]), (400, [1e9] * 9)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, score int").repartition(3)
    got = topk.top_k(df, k=5).collect()
    assert sorted(_brute_top(rows, 5, 20)) == sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def test_top_k_small_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], schema)).collect() == []
    got = topk.top_k(spark.createDataFrame([(20, [1.0]), (21, [-0.01]), (40, [0.5])], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(20, 1, 40, 2048), (20, 2, 21, -64), (40, 1, 20, 2048), (40, 2, 21, -32)]


def test_the_largest_component_of_a_bucket_has_no_pivots(spark, monkeypatch):
    import numpy as np

    ids = lambda cls: np.arange(cls * 100, cls * 100 + 10, dtype=np.uint64)
    sets = spark.createDataFrame(
        [(c, 10, bytearray(ids(c).tobytes()), bytearray(near_dup.bitmap(ids(c)).tobytes())) for c in range(32)], "cls long, n long, ids binary, bits binary"
    )
    comp = spark.createDataFrame([(c, 0) for c in range(30)], "node long, component long")
    members = spark.createDataFrame([(1, c, 32) for c in range(32)], "key long, cls long, size long")
    landed, land = {}, near_dup.land
    monkeypatch.setattr(near_dup, "land", lambda df, name, *a: landed.setdefault(name, []).append(land(df, name, *a)) or landed[name][-1])
    got = {r.node: r.component for r in near_dup._rounds(members, comp, sets, 80).collect()}
    assert got == {c: 0 for c in range(30)}
    assert sorted(r.cls for df in landed["near-pivots"] for r in df.collect()) == [30, 31]


def test_confirming_few_pairs_moves_few_sets(spark):
    import numpy as np

    ids = lambda cls: np.sort(np.random.default_rng(cls // 2).integers(0, 2**63, 32, dtype=np.uint64))
    sets = near_dup.land(spark.createDataFrame([(c, bytearray(ids(c).tobytes())) for c in range(4000)], "cls long, ids binary"), "test-sets")
    unread = spark.range(9).selectExpr("id as cls", "cast(raise_error('sets are read') as binary) as ids")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 50_000)
    try:
        found = near_dup.confirm(spark.createDataFrame([(0, 1), (1, 2), (6, 7)], "a long, b long"), sets, 80)
        assert sorted(map(tuple, found.collect())) == [(0, 1), (6, 7)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"BroadcastHashJoin \[cls#\d+L\], \[cls#\d+L\], LeftSemi", plan)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        none = spark.range(9).where("id > 9").selectExpr("id as a", "id as b")
        assert near_dup.confirm(none, unread, 80).collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_near_dedup_leaves_the_texts_that_stay_in_place(spark, docs_of, monkeypatch):
    landed, land = {}, near_dup.land
    monkeypatch.setattr(near_dup, "land", lambda df, name: landed.setdefault(name, land(df, name)))
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows = [(i, text(i)) for i in range(300)] + [(300 + i, text(i) + " more") for i in range(5)] + [(400, ""), (401, None), (None, text(7))]
    out = near_dup.one_of_each(docs_of(rows))
    last = list(landed.values())[-1]
    assert last.count() == 6  # what is joined with the texts: the rows that go, not those that stay
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search("Join .*LeftAnti", plan) and "LeftSemi" not in plan
    assert sorted(r.doc_id for r in out.collect()) == [*range(300), 400, 401]


def test_near_dedup_moves_full_sets_once(spark, docs_of, monkeypatch):
    landed, land = {}, near_dup.land

    def kept(df, name):
        out = land(df, name)
        if name == "near-sets":
            landed["sets"], landed["rows"] = df._jdf.queryExecution().executedPlan().toString(), out.count()
        return out

    monkeypatch.setattr(near_dup, "land", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = " ".join(f"w{j}" for j in range(40))
        rows = [(i % 3, text + (" more" if i % 2 else "")) for i in range(12)] + [(50, "one two three four five six")]
        found = near_dup.near_duplicates(docs_of(rows)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert landed["rows"] == 2  # repeated rows give a class one set
    assert sorted({(r.doc_id, r.component_id) for r in found}) == [(0, 0), (1, 0), (2, 0), (50, 50)]
    initial = landed["sets"].split("== Initial Plan ==")[0]
    # Of the exchanges, only the one before the join has the sets.
    assert len(re.findall(r"Exchange hashpartitioning\(digest", initial)) == 2
    assert not re.search(r"Exchange hashpartitioning\(cls", initial)


def test_rounds_take_a_class_once_for_each_half_key(docs_of, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 2)
    landed, land = {}, near_dup.land
    monkeypatch.setattr(near_dup, "land", lambda df, name, *a: landed.setdefault(name, []).append(land(df, name, *a)) or landed[name][-1])
    rows = _near_rows(groups=2, size=40)
    got = near_dup.near_duplicates(docs_of(rows), words=2).collect()
    assert sorted(map(str, _components(rows, 2))) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got)
    dealt = landed["near-dealt"][0].where("not pivot")
    assert 0 < dealt.groupBy("cls").count().agg({"count": "max"}).first()[0] <= near_dup.HALVES


def test_top_k_gives_no_rows_below_the_cutoff(spark, monkeypatch):
    landed, land = {}, topk.land
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(topk, "land", lambda df, name, *a: landed.setdefault(name, land(df, name, *a)))
    rng = random.Random(5)
    rows = [(i, [rng.random() for _ in range(8)]) for i in range(2000)]
    assert topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5).count() == 500
    both = landed["topk-reaching"].join(landed["topk-cutoffs"], ["dim", "q_block", "q"])
    assert both.count() >= 500 and both.where("score < cutoff").count() == 0
