"""Classifier, personal data, mixing, packing, training order."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF_ORACLE
from tidewater.llm import mixing, packing, pii, quality, tokens, training_order
from tidewater.llm.common import table

ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (4, "word " * 30_000), (5, "\x1c x  y  z\n\n q <|endoftext|>")]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in table(spark, SF_ORACLE, "documents").select("text").collect()]


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    got = quality.score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == r.quality for r in held) / len(held)
    assert right > 0.9 and all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_quality_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([(3, None, 0), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs_of(ODD), labels).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    assert quality.keep_good(docs_of(ODD), labels).count() == len(ODD)
    assert quality.score_documents(docs_of(ODD).where("false"), labels).collect() == []


def test_quality_network_covers_the_whole_text_and_learns():
    m = quality.init_model()
    long = "a" * 200_000
    assert quality.document_score(m, long) != quality.document_score(m, long[:-400] + "#" * 400)
    assert quality.document_score(m, None) == quality.document_score(m, "")
    data = [np.frombuffer(x.encode(), np.uint8) for x in ("abc def " * 90, "#!" * 300)]
    y = np.array([1.0, 0.0], np.float32)
    g = quality._gradients(m, data, y)

    def loss():
        p = [quality.document_score(m, d.tobytes().decode()) for d in data]
        return -(np.log(p[0]) + np.log(1 - p[1])) / 2

    for name in ("filters", "hidden", "out", "bias"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        before, step = m[name][at], 1e-2
        m[name][at] = before + step
        up = loss()
        m[name][at] = before - step
        down = loss()
        m[name][at] = before
        assert (up - down) / (2 * step) == pytest.approx(g[name][at], rel=0.1, abs=1e-4)


def _brute_spans(t):
    found = []
    for k, p in enumerate((
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if (
                k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split("."))
                or k == 2 and 14 <= len(d) <= 19 and pii.luhn(d) or k == 3 and 10 <= len(d) <= 15
            ):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_spans_match_the_patterns(texts):
    rng = random.Random(8)
    odd = ["".join(rng.choice("ab@.-+ 0123456789()%é") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    odd += ["x@y.z@w.v", "..@x.y.z a@@b.c", "1.2.3.4.5.6.7.8", "00001.002.3.4", "9" * 5000, "+" * 500, "4111 1111-1111 1111"]
    for t in odd + texts[:500]:
        assert pii.base_spans(t) == _brute_spans(t), t[:80]


def test_personal_data(spark, docs_of):
    docs = table(spark, SF_ORACLE, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.personal_data(docs).collect():
        base = _brute_spans(rows[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(r.spans.split(",")) | {""}
        assert not base or "<" in r.redacted
    got = pii.personal_data(docs_of([*ODD, (9, "a@b.cd")])).collect()
    assert len(got) == len(ODD) + 1 and {r.spans for r in got} == {"", "email:0:6"}
    assert pii.personal_data(docs_of(ODD).where("false")).collect() == []


def test_personal_data_adds_other_formats(texts):
    model = pii.train([t for t in texts if re.search("[0-9]", t)])
    for t, want in (
        ("write to john.34 [at] mail7 [dot] example.com please", "email"), ("host 10[.]0[.]0[.]1 is up", "ip"),
        ("from 4111.1111.1111.1111 then", "card"), ("call (017) 555-7713 now", "phone"),
    ):
        base, spans = pii.find(t, model)
        assert base == [] and [pii.KINDS[k] for _, k, _ in spans] == [want], t
    assert pii.find("look at me. he was at home dot well in 1999-2003", model) == ([], [])
    clean = [t for t in texts if not _brute_spans(t)]
    assert sum(bool(pii.find(t, model)[1]) for t in clean) <= len(clean) // 200


NUMBERS = [
    ("2024-03-05 12:30 415-555-2671", ["415-555-2671"]), ("tel 415-555-2671 / 415-555-2672", ["415-555-2671", "415-555-2672"]),
    ("(415) 555-2671 (415) 555-2672", ["(415) 555-2671", "(415) 555-2672"]),
    ("2024-03-05 4111.1111.1111.1111", ["4111.1111.1111.1111"]), ("415-555-2671 415-555-2672 415-555-2673", ["415-555-2672"]),
    ("7 " * 5000 + "415-555-2671", ["415-555-2671"]),
]


def test_numbers_are_proposed_in_runs_of_any_length():
    for t, want in NUMBERS:
        got = pii.candidates(t)
        assert set(want) <= {t[a:b] for a, k, b in got if k in (2, 3)}, t[:60]
        assert len(got) <= 40 * len(re.findall("[0-9]+", t))
        for a, k, b in got:
            assert k == 1 or (13, 9)[k - 2] <= len(re.sub("[^0-9]", "", t[a:b])) <= (19, 15)[k - 2]


def test_personal_data_in_runs_of_numbers(texts):
    model = pii.train([t for t in texts if re.search("[0-9]", t)])
    for t, want in NUMBERS[:4]:
        text = f"please call {t} now"
        assert [text[a:b] for a, _, b in pii.find(text, model)[1]] == want, t


def test_personal_data_learns_a_rare_kind_from_all_documents(spark, docs_of):
    """Few documents hold an address, all of them long; many are copies."""
    rng = random.Random(4)
    rows = [(k, f"call +1 415 555 {k % 700:04d} or 2024 {k} 99 17 22 of {rng.random():.6f}") for k in range(3000)]
    rows += [(9000 + k, "a copy +1 415 555 2671 of 10.20.30.40 ") for k in range(300)]
    ip = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))
    rows += [(5000 + k, "word " * 11_000 + f"host {ip()} is up, {rng.random()} " + "end " * 20) for k in range(60)]
    docs = docs_of(rows)
    model = pii.fit(docs, sample=40)
    base, spans = pii.find("word word host 10[.]0[.]0[.]1 is up, as ever", model)
    assert base == [] and [pii.KINDS[k] for _, k, _ in spans] == ["ip"]
    local = pii.train([t for _, t in rows], sample=40)
    assert local["threshold"] == model["threshold"]


def test_mixing_reaches_the_margins(spark):
    docs = table(spark, SF_ORACLE, "documents")
    got = mixing.mixture(docs, budget=0.1).toPandas()
    assert len(got) == docs.count() and got.probability.between(0, 1).all()
    got["w"] = got.n_tokens * got.probability
    total = 0.1 * got.n_tokens.sum()
    assert got.w.sum() == pytest.approx(total, rel=0.01)
    for lang, share in mixing.LANGUAGES.items():
        assert got[got.lang == lang].w.sum() == pytest.approx(share * total, rel=0.02)
    natural = got.groupby("source").n_tokens.sum() ** 0.5
    want = natural / natural.sum() * total
    assert (got.groupby("source").w.sum() / want - 1).abs().max() < 0.02
    drawn = got[got.selected].n_tokens.sum()
    assert drawn == pytest.approx(total, rel=0.35)


def test_rake_matches_a_plain_fit_and_never_exceeds_a_cell(spark):
    rng = np.random.default_rng(3)
    n = rng.integers(1, 1000, (5, 3, 2))
    cells = spark.createDataFrame(
        [(f"s{i}", f"l{j}", f"t{k}", int(n[i, j, k])) for i in range(5) for j in range(3) for k in range(2)],
        "source string, lang string, topic string, n long",
    )
    shares = {"source": {f"s{i}": 0.2 for i in range(5)}, "lang": {"l0": 0.5, "l1": 0.3, "l2": 0.2, "l9": 0.5}, "topic": {"t0": 0.5, "t1": 0.5}}
    got = {(r.source, r.lang, r.topic): r.w for r in mixing.rake(cells, shares, 0.1 * n.sum()).collect()}
    w, total = n.astype(float), 0.1 * n.sum()
    for _ in range(200):
        w *= (0.2 * total / w.sum((1, 2)))[:, None, None]
        w *= (np.array([0.5, 0.3, 0.2]) * total / w.sum((0, 2)))[None, :, None]
        w *= (0.5 * total / w.sum((0, 1)))[None, None, :]
    for (s, l, t), x in got.items():
        assert x == pytest.approx(w[int(s[1]), int(l[1]), int(t[1])], rel=0.02)
    full = mixing.rake(cells, {"source": {"s0": 1.0}}, float(n.sum())).collect()
    assert all(r.w == (r.n if r.source == "s0" else 0) for r in full)


def test_mixing_defaults_sample_every_language(spark):
    langs = ["en", "de", None, "it", "zh", "EN", "en-US"]
    rows = [(i, f"plain words {i} of a text", langs[i % len(langs)], "s") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mixture(docs, budget=0.1).toPandas()
    got["lang"] = got.lang.fillna("(none)")
    got["w"] = got.n_tokens * got.probability
    share = got.groupby("lang").w.sum() / got.w.sum()
    assert (got.probability > 0).all() and share.drop(["en", "de"]).to_numpy() == pytest.approx([1 / 7] * 5, rel=0.01)
    assert share["en"] == pytest.approx(2 / 7 * 5 / 7, rel=0.01) and share["de"] == pytest.approx(2 / 7 * 2 / 7, rel=0.01)
    none = mixing.mixture(docs.where("lang is null"), budget=0.5).toPandas()
    assert len(none) == 100 and none.probability.to_numpy() == pytest.approx([0.5] * 100, rel=0.01) and none.selected.any()


def test_mixing_edge_cases(docs_of):
    got = mixing.mixture(docs_of(ODD), targets={"source": 0.5, "lang": 1.0, "topic": 1.0}).collect()
    assert len(got) == len(ODD) and {r.source for r in got} == {"s", None}
    assert mixing.mixture(docs_of(ODD).where("false")).collect() == []
    assert mixing.sample_mixture(docs_of([(1, None), (2, "")])).collect() == []
    assert mixing.sample_mixture(docs_of(ODD), budget=1.0).columns == docs_of(ODD).columns


def test_ids_equal_the_tokenizers(texts):
    enc = tokens.encoder()
    odd = ["a  b   c\n\n d \n e", " lead", "tail ", "  ", "\n", "x\x1c y", "don't  it's", "<|endoftext|> x", "a  b　c", "  x", "1 2  3"]
    rng = random.Random(1)
    odd += ["".join(rng.choice("ab 1\n\t .'sé\x1c") for _ in range(40)) for _ in range(2000)]
    for t in odd + texts[:300]:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == enc.model.encode(t, add_special_tokens=False).ids, repr(t)


def _ids(t, special_text=False):
    return np.frombuffer(tokens.encoder(special_text=special_text).ids(t) + bytes(4), "<u4")


@pytest.mark.parametrize("size", [64, 2048])
def test_packing(spark, docs_of, size):
    base = [(r.doc_id, r.text) for r in table(spark, SF_ORACLE, "documents").limit(300).collect()] + ODD
    got = packing.pack(docs_of(base), size=size).toPandas()
    assert got.length.between(1, size).all()
    x = got.sort_values(["sequence_id", "offset"])
    assert (x.groupby("sequence_id").length.cumsum() - x.length == x.offset).all()
    assert x.groupby("sequence_id").length.sum().max() <= size
    want = []
    for i, t in base:
        ids = _ids(t)
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    rows = [(None if r[0] != r[0] else int(r[0]), *map(int, r[1:])) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(map(str, rows)) == sorted(map(str, want))
    assert got.sequence_id.nunique() <= 1.03 * -(-got.length.sum() // size) + 1


def test_packing_empty(docs_of):
    assert packing.pack(docs_of(ODD).where("false")).collect() == []
    assert [r.length for r in packing.pack(docs_of([(1, None)])).collect()] == [1]


def test_crossover_keeps_every_piece_once_and_evolution_helps():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1500, 900)
    a, b = (packing.first_packing(lengths, 2048, rng, noise) for noise in (0.0, 1.0))
    for child in (packing.crossover(b, a, lengths, 2048, rng), packing.mutate(a, lengths, 2048, rng)):
        assert sorted(x for g in child.bins for x in g) == list(range(900))
        assert max(child.fill) <= 2048 and child.fill == [int(lengths[g].sum()) for g in child.bins]
    best = packing.evolve([b], lengths, 2048, rng)[0]
    assert len(best.bins) <= len(a.bins) and best.key() < b.key()


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 70_001])
def test_feistel_is_a_permutation(n):
    slots = training_order.feistel(np.arange(n), n, key=5)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert slots.tolist() != training_order.feistel(np.arange(n), n, key=6).tolist()
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.1


def test_training_order_round_trip(spark, docs_of, tmp_path):
    base = [(r.doc_id, r.text) for r in table(spark, SF_ORACLE, "documents").limit(200).collect() if r.doc_id > 9] + ODD[:3] + ODD[4:]
    settings = {"length": 128, "shard_bytes": 128 * 2 * 50}
    got = training_order.materialise(docs_of(base, 5), str(tmp_path), key=3, **settings).collect()
    stream = np.concatenate([np.append(_ids(t, special_text=True)[:-1], 50256) for _, t in sorted(base, key=lambda r: (r[0] is not None, r[0] or 0))])
    count = -(-len(stream) // 128)
    stream = np.append(stream, np.full(count * 128 - len(stream), 50256)).reshape(count, 128)
    assert sorted(r.slot for r in got) == sorted(r.sequence for r in got) == list(range(count))
    data = training_order.read_slots(str(tmp_path), 0, count, **settings)
    order = training_order.feistel(np.arange(count), count, 3)
    assert (data[order] == stream).all()
    assert (training_order.read_slots(str(tmp_path), 45, 60, **settings) == data[45:105]).all()
    for r in got:
        assert order[r.sequence] == r.slot and r.shard == r.slot // 50 and r.shard_offset == r.slot % 50 * 256
        assert r.ids_crc32 == zlib.crc32(data[r.slot].tobytes())
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_training_order_with_many_null_and_repeated_ids_and_a_long_text(docs_of, tmp_path):
    rng = random.Random(6)
    base = [(rng.choice([None, 7, k]), "w " * rng.randint(0, 60) + str(k)) for k in range(300)] + [(7, "long text " * 20_000), (None, None), (7, "")]
    settings = {"length": 32, "shard_bytes": 32 * 2 * 40}
    got = training_order.materialise(docs_of(base, 6), str(tmp_path), key=9, **settings).collect()
    count = len(got)
    assert count == -(-sum(len(_ids(t, special_text=True)) for _, t in base) // 32) and {r.n_tokens for r in got if r.sequence < count - 1} == {32}
    stream = training_order.read_slots(str(tmp_path), 0, count, **settings)[training_order.feistel(np.arange(count), count, 9)].ravel()
    ends = np.flatnonzero(stream == 50256)[: len(base)]
    texts = [x[:-1].tobytes() for x in np.split(stream, ends + 1)[: len(base)]]
    ids_of = lambda t: _ids(t, special_text=True)[:-1].astype("<u2").tobytes()
    nulls = sum(i is None for i, _ in base)
    # Null ids first, then by id; rows of one id in any order.
    assert sorted(texts[:nulls]) == sorted(ids_of(t) for i, t in base if i is None)
    sevens = sum(i is not None and i < 7 for i, _ in base) + nulls
    repeated = [ids_of(t) for i, t in base if i == 7]
    assert sorted(texts[sevens : sevens + len(repeated)]) == sorted(repeated)
    assert texts[sevens + len(repeated) :] == [ids_of(t) for i, t in sorted((r for r in base if r[0] is not None and r[0] > 7), key=lambda r: r[0])]


def test_training_order_empty(docs_of):
    assert training_order.materialise(docs_of(ODD).where("false")).collect() == []


def test_ids_of_every_code_point_token_and_random_text():
    enc = tokens.encoder(special_text=True)
    assert enc.fast is not None and enc.top == 50256
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}. {c}{c}a" for c in points]
    table = [t for b in tokens.ranks(_path()) if (t := b.decode("utf-8", "ignore")).encode() == b]
    rng = random.Random(4)
    texts += table + ["".join(rng.choices(table, k=rng.randint(1, 25))) for _ in range(20_000)]
    for i in range(0, len(texts), 4096):
        want = enc.model.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)
        for t, w in zip(texts[i : i + 4096], want):
            assert enc.ids(t) == np.array(w.ids, "<u4").tobytes(), repr(t)


def _path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("special_text", [False, True])
def test_ids_of_odd_texts(special_text):
    enc = tokens.encoder(special_text=special_text)
    odd = ["a  b", " x", "  ", "a \n b", "don't, we'll. <|endoftext|>, x!!", "x \x85 y", "a\x1cb c", "ab, c,\n d.", "é. ñ!? ,, . ..", "a1, b2. c", "中文, 字.", "o'clock's, '.s"]
    odd += ["ab" * 200_000, " \n\t" * 100_000, "." * 300_000]
    for text in [*odd, " ".join(odd)]:
        assert enc.ids(text) == np.array(enc.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert enc.ids(None) == enc.ids("") == b""


def test_other_tokenizers_are_not_taken_for_ranks(tmp_path):
    import json

    import public_tokenizers

    assert tokens.ranks(public_tokenizers.path("word_bpe_49k.json")) is None
    enc = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert enc.ids("Some Words.") == np.array(enc.model.encode("Some Words.", add_special_tokens=False).ids, "<u4").tobytes()
    spec = json.load(open(_path(), encoding="utf-8"))
    spec["model"]["merges"][300], spec["model"]["merges"][900] = spec["model"]["merges"][900], spec["model"]["merges"][300]
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    assert tokens.ranks(str(tmp_path / "t.json")) is None
