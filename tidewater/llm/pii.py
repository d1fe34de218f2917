"""Personal data by candidate gradient boosting (operator 3).

Base spans are found by fixed patterns and always stay. High-recall
generators propose further, overlapping spans: spelled-out addresses, numbers
with other separators, national phone formats. Boosted trees score them from
format and context, and a threshold per kind, calibrated for precision on
contexts that the trees haven't seen, selects which are added.

There are no labelled spans to learn from, so the trees learn from base
spans: as found, rewritten into the formats that the generators look for, and
spoilt (a wrong check digit, an address part above 255) as counterexamples,
beside candidates in ordinary text that no base span backs.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import land

KINDS = ("email", "ip", "card", "phone")
# Fixed: the base patterns. Possessive forms match the same spans in linear time.
BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SAMPLE = 1000  # distinct contexts that are learned from, at most: of base spans, and of other candidates, per kind
SIDE = 60  # characters of context on either side of a span
FORMS = 4  # a base span is rewritten and spoilt so many times
FOLDS = 4  # the thresholds rest on scores by trees that haven't seen a context's fold
CELLS = 1000  # of a score histogram
PRECISION, LEAST = 0.97, 10  # of the rows above a threshold; and how many there are at least
DEPTH, TREES, BINS, RATE = 3, 40, 16, 0.2

# The sign in every spelled address, at most 67 code points after its start, and how it goes on.
_AT = re.compile(
    r"(?:(?<=[\s\[({])at(?=[\s\])}])|@)(?=\s?[\])}]?\s?[A-Za-z0-9-]{1,63}(?:\s?[\[({]\s?dot\s?[\])}]|\sdot\s|\.)\s?[A-Za-z0-9-])",
    re.I,
)
_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|\s?@\s?)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)[A-Za-z0-9-]{1,63}){1,4}",
    re.I,
)
_ZONE = re.compile(r"[+(]?[0-9][0-9 ().\-/:\[\] ]*[0-9]")
_DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?(?:\[\.\]|\(\.\)|\.|:|-)\s?[0-9]{1,3}){3}(?![0-9])")
_GROUP = re.compile(r"[+(]?[0-9]+\)?")
_DIGITS = re.compile(r"[0-9]")
_HINTS = re.compile(r"tel|phone|call|fax|mobil|mail|contact|card|visa|kart|tarj|carte|ip\b|addr|host|server", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(text: str):
    """Every match goes through an ``@``; its local part is the longest run
    of allowed characters before it that no earlier match has taken."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = start < at and DOMAIN.match(text, at + 1)
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for k, kind in enumerate(KINDS[1:], 1):
        if kind == "phone" and "+" not in text:
            continue
        for m in BASE[kind].finditer(text):
            s = m.group()
            digits = "".join(_DIGITS.findall(s))
            if kind == "ip":
                ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
            elif kind == "card":
                ok = 14 <= len(digits) <= 19 and luhn(digits)
            else:
                ok = 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """High-recall proposals, overlapping ones and base spans included."""
    out = set()
    done = 0
    for at in _AT.finditer(text):
        i = at.start()
        # No match with this sign ends later; one that starts behind it has a sign of its own.
        m = _SPELLED.search(text, max(done, i - 67), i + 400) if i >= done else None
        if m and m.start() < i:
            done = m.end()
            out.add((m.start(), 0, done))
    if not _DIGITS.search(text):
        return sorted(out)
    out |= {(m.start(), 1, m.end()) for m in _DEFANGED.finditer(text)}
    out.update(numbers(text))
    return sorted(out)


def numbers(text: str):
    """Every run of whole digit groups, in a run of digits and separators of
    any length, whose digit count fits a kind. No kind holds more than 19
    digits, so a group starts at most 19 runs."""
    for zone in _ZONE.finditer(text):
        groups = [(*g.span(), sum(c.isdigit() for c in g.group())) for g in _GROUP.finditer(text, *zone.span())]
        for i, (start, _, _) in enumerate(groups):
            n = 0
            for _, end, d in groups[i : i + 19]:
                n += d
                if n > 19:
                    break
                if n >= 13:
                    yield start, 2, end
                if 9 <= n <= 15:
                    yield start, 3, end


class Overlaps:
    """Whether a span touches one of ``spans``, in logarithmic time."""

    def __init__(self, spans):
        spans = sorted(spans)
        self.starts = [a for a, _, _ in spans]
        self.ends = np.maximum.accumulate([b for _, _, b in spans]).tolist() if spans else []

    def __contains__(self, span) -> bool:
        i = bisect_left(self.starts, span[2])
        return i > 0 and self.ends[i - 1] > span[0]


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;:!?" else 5


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    start, kind, end = span
    s = text[start:end]
    digits = "".join(_DIGITS.findall(s))
    groups = re.findall(r"[0-9]+", s)
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    before = text[max(0, start - 24) : start]
    number = [int(g) for g in groups if len(g) <= 6]
    return [
        *(float(kind == k) for k in range(4)),
        len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(seps), len(set(seps)), max(map(len, seps), default=0),
        float(14 <= len(digits) <= 19 and luhn(digits)), float(10 <= len(digits) <= 15),
        float(len(groups) == 4 and len(number) == 4 and max(number) <= 255), max(number, default=0),
        float(s.startswith("+")), float("(" in s), s.count("."), s.count("-"), s.count(" "), float("/" in s or ":" in s),
        float("@" in s), float(bool(re.search(r"\bat\b", s, re.I))), float(bool(re.search(r"\bdot\b|\.", s, re.I))),
        float(bool(re.search(r"[\[({]\s?(?:at|dot)", s, re.I))), float(bool(re.search(r"[0-9]", s.split("@")[0][:40]))),
        len(re.split(r"dot|\.", s, flags=re.I)[-1].strip()),
        len(set(digits)), float(groups[0].startswith("0")) if groups else 0.0,
        _side(text[start - 1 : start]), _side(text[end : end + 1]),
        float(bool(_HINTS.search(before))), sum(c.isdigit() for c in before), sum(c.isupper() for c in before),
        float(text[:start].count("\n", max(0, start - 40)) > 0),
    ]


def rewritten(kind: int, s: str, rng) -> str:
    """A base span in one of the formats that base patterns miss."""
    if kind == 0:
        local, _, domain = s.partition("@")
        at, dot = ((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "))[rng.integers(3)]
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return s.replace(".", "[.]" if rng.random() < 0.5 else "(.)")
    digits = "".join(_DIGITS.findall(s))
    if kind == 2:
        sep = (".", "/", " ")[rng.integers(3)]
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, rest = digits[-10:-7], digits[-7:]
    return (f"({area}) {rest[:3]}-{rest[3:]}", f"{area}-{rest[:3]}-{rest[3:]}", f"00{digits[:-10]} {area} {rest}")[rng.integers(3)]


def spoilt(kind: int, s: str, rng) -> str:
    """A near miss of a base span: what must not be selected."""
    at = [m.start() for m in _DIGITS.finditer(s)]
    if kind == 0:
        return s.replace("@", " at ").split(".")[0]
    if kind == 1:
        parts = s.split(".")
        parts[rng.integers(4)] = str(rng.integers(256, 1000))
        return ".".join(parts)
    if kind == 2:
        i = at[rng.integers(len(at))]
        return s[:i] + str((int(s[i]) + 1 + rng.integers(8)) % 10) + s[i + 1 :]
    return s[: at[rng.integers(3, 7)]] + "".join(str(x) for x in rng.integers(0, 10, 14))


def neighbour(s: str, rng) -> tuple[str, bool]:
    """What may stand before a number in the same run of digits and separators:
    nothing, a date and time, or another number of its kind (then True)."""
    pick = rng.integers(4)
    if pick < 2:
        return "", False
    x = rng.integers(1, [2100, 13, 29, 24, 60])
    if pick == 2:
        return f"{max(x[0], 1900)}-{x[1]:02d}-{x[2]:02d} " + (f"{x[3]:02d}:{x[4]:02d} " if rng.random() < 0.5 else ""), False
    other = _DIGITS.sub(lambda m: str(rng.integers(1, 10)), s)
    return other, True


def examples(text: str):
    """``(hash, kind, base, context, start, end)`` of base spans (base is 1) and
    of the candidates that touch none (0). Equal contexts have one hash."""
    base = base_spans(text)
    touching = Overlaps(base)
    for label, spans in ((1, base), (0, (c for c in candidates(text) if c not in touching))):
        for a, k, b in spans:
            context, start = text[max(0, a - SIDE) : b + SIDE], min(a, SIDE)
            key = f"{k} {label} {start} {b - a} {context}".encode("utf-8", "surrogatepass")
            h = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True)
            yield h, k, label, context, start, start + b - a


def training_rows(example):
    """``(features, label, kind, rival)`` of what one example teaches: itself,
    and for a base span its rewritten and spoilt forms. ``rival`` is how many
    rows before a row stands the span of its kind that it overlaps, or 0.
    Follows from the example."""
    h, k, label, context, a, b = example
    rng = np.random.default_rng(h % 2**63)
    span = (a, k, b)
    if not label or span in candidates(context):
        yield features(context, span), label, k, 0
    if not label:
        return
    for make, good in ((rewritten, 1), (spoilt, 0), (lambda *z: rewritten(z[0], spoilt(*z), z[2]), 0)) * FORMS:
        s = make(k, context[a:b], rng)
        before, start = context[:a], a
        right = []
        if good and k > 1:
            lead, same = neighbour(s, rng)
            if same:
                right.append((start, k, start + len(lead)))
                lead += (" / ", " ", " - ")[rng.integers(3)]
            before, start = before + lead, start + len(lead)
        changed = before + s + context[b:]
        span = (start, k, start + len(s))
        if good or k != 3:
            yield features(changed, span), good, k, 0
        if good and k > 1:  # runs that cut or join numbers
            wrong = [c for c in numbers(changed) if c[2] > a and c[0] < span[2] and c not in (span, *right)]
            for i, at in enumerate(rng.permutation(len(wrong))[:3], 1):
                c = wrong[at]
                yield features(changed, c), 0, c[1], i if c[1] == k and c[2] > start else 0


def boost(x: np.ndarray, y: np.ndarray) -> dict:
    """Histogram gradient boosting of complete trees on the log loss."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="nearest")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(p0 / (1 - p0)))
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), int)
        feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
        for d in range(DEPTH):
            base = 2**d - 1
            for n in range(2**d):
                here = node == n
                if here.sum() < 10:
                    continue
                best = 1e-6
                gs, hs = g[here].sum(), h[here].sum()
                for f, e in enumerate(edges):
                    b = binned[here, f]
                    gl = np.bincount(b, g[here], len(e) + 1).cumsum()[:-1]
                    hl = np.bincount(b, h[here], len(e) + 1).cumsum()[:-1]
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if len(gain) and gain.max() > best:
                        best, feature[base + n], cut[base + n] = gain.max(), f, e[gain.argmax()]
            at = base + node
            node = 2 * node + (x[np.arange(len(y)), feature[at]] > cut[at])
        leaf = -np.bincount(node, g, 2**DEPTH) / (np.bincount(node, h, 2**DEPTH) + 1) * RATE
        score += leaf[node]
        trees.append((feature, cut, leaf))
    return {"start": float(np.log(p0 / (1 - p0))), "trees": trees}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, cut, leaf in model["trees"]:
        node = np.zeros(len(x), int)
        for d in range(DEPTH):
            at = 2**d - 1 + node
            node = 2 * node + (x[rows, feature[at]] > cut[at])
        score += leaf[node]
    return 1 / (1 + np.exp(-score))


def fitted(chosen: list) -> dict | None:
    """Trees from the examples, and for calibration trees without each fold
    (None where too little is left)."""
    rows = [(e[0] % FOLDS, *r) for e in sorted(chosen) for r in training_rows(e)]
    if len({r[2] for r in rows}) < 2:
        return None
    fold, x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64), np.array([r[2] for r in rows])
    return boost(x, y) | {"folds": [boost(x[fold != f], y[fold != f]) if len(set(y[fold != f].tolist())) == 2 else None for f in range(FOLDS)]}


def score_cells(model: dict, some: list) -> list[list[int]]:
    """Per example the histogram cells (kind, label, score) of its rows."""
    out: list[list[int]] = [[] for _ in some]
    for f, trees in enumerate(model["folds"]):
        rows = [(i, *r) for i, e in enumerate(some) if e[0] % FOLDS == f for r in training_rows(e)] if trees else []
        if rows:
            p = predict(trees, np.array([r[1] for r in rows], np.float64)).tolist()
            for at, (x, (i, _, label, k, rival)) in enumerate(zip(p, rows)):
                if not rival or x > p[at - rival]:  # else the better one is added in its place
                    out[i].append((k * 2 + label) * CELLS + min(int(x * CELLS), CELLS - 1))
    return out


def thresholds(counts: Mapping[int, int]) -> list[float]:
    """Per kind the least cell bound from which precision is PRECISION over at
    least LEAST rows; none: infinite."""
    n = np.zeros(4 * 2 * CELLS, np.int64)
    for cell, c in counts.items():
        n[cell] = c
    wrong, right = n.reshape(4, 2, CELLS)[:, :, ::-1].cumsum(axis=2).transpose(1, 0, 2)
    ok = (right >= PRECISION * (right + wrong)) & (right + wrong >= LEAST)
    return [max(0.5, (CELLS - 1 - int(np.nonzero(x)[0][-1])) / CELLS) if x.any() else np.inf for x in ok]


def train(texts: list[str], sample: int = SAMPLE) -> dict | None:
    """What :func:`fit` does, for texts at hand."""
    found = {e[0]: e for t in texts for e in examples(t or "")}
    model = fitted([e for k in range(4) for x in (0, 1) for e in sorted(e for e in found.values() if e[1:3] == (k, x))[:sample]])
    if model is not None:
        model["threshold"] = thresholds(Counter(c for cells in score_cells(model, list(found.values())) for c in cells))
    return model


def find(text: str, model: dict | None) -> tuple[list, list]:
    """Base spans, and all spans with those that the model adds. Added spans
    overlap neither a base span nor a better added one."""
    base = base_spans(text)
    if model is None:
        return base, base
    touching = Overlaps(base)
    rest = [c for c in candidates(text) if c not in touching]
    good = []
    for at in range(0, len(rest), 4096):
        part = rest[at : at + 4096]
        p = predict(model, np.array([features(text, c) for c in part], np.float64))
        good += [(-x, c[0] - c[2], c) for x, c in zip(p.tolist(), part) if x >= model["threshold"][c[1]]]
    taken: set[int] = set()
    added: list[tuple[int, int, int]] = []
    for _, _, c in sorted(good):  # the best first, of equals the longest
        if taken.isdisjoint(range(c[0], c[2])):
            taken.update(range(c[0], c[2]))
            added.append(c)
    return base, sorted(base + added)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, done = [], 0
    for a, k, b in spans:
        if a >= done:
            out += [text[done:a], f"<{KINDS[k]}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def _least(sample: int):
    """Of each kind's base spans and other candidates in a task's documents,
    the ``sample`` distinct examples of least hash."""

    def run(batches):
        held = [({}, []) for _ in range(8)]  # examples by hash, and a heap of the negated hashes
        for b in batches:
            for t in b.column(0).to_pylist():
                for e in examples(t or ""):
                    known, heap = held[e[1] * 2 + e[2]]
                    if e[0] in known or len(heap) >= sample and e[0] >= -heap[0]:
                        continue
                    known[e[0]] = e
                    heapq.heappush(heap, -e[0])
                    if len(heap) > sample:
                        del known[-heapq.heappop(heap)]
        rows = [e for known, _ in held for e in known.values()]
        yield pa.RecordBatch.from_pylist([dict(zip(_EXAMPLE.names, e)) for e in rows], _EXAMPLE)

    return run


def _scored(model: dict):
    def run(batches):
        def out():
            return pa.RecordBatch.from_pylist([{"h": e[0], "cells": c} for e, c in zip(some, score_cells(model, some))], _CELLS)

        some = []
        for b in batches:
            for t in b.column(0).to_pylist():
                for e in examples(t or ""):
                    some.append(e)
                    if len(some) >= 2000:
                        yield out()
                        some.clear()
        yield out()

    return run


_EXAMPLE = pa.schema([("h", pa.int64()), ("kind", pa.int64()), ("base", pa.int64()), ("context", pa.string()), ("a", pa.int64()), ("b", pa.int64())])
_CELLS = pa.schema([("h", pa.int64()), ("cells", pa.list_(pa.int64()))])


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Trees, trained in one task on at most ``sample`` distinct contexts of
    base spans and as many of other candidates per kind, from all documents;
    thresholds from all distinct contexts of all documents, each scored by
    trees that haven't seen its fold. Only the model and the score histogram
    reach the driver."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    least = texts.mapInArrow(_least(sample), "h long, kind long, base long, context string, a long, b long").dropDuplicates(["h"])
    first = Window.partitionBy("kind", "base").orderBy("h")
    chosen = land(least.withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample).drop("r"), "pii-examples")

    def run(frames):
        yield pd.DataFrame({"model": [pickle.dumps(fitted([e for f in frames for e in f.itertuples(index=False, name=None)]))]})

    found = chosen.coalesce(1).mapInPandas(run, "model binary").collect()
    model = pickle.loads(found[0]["model"]) if found else None
    if model is None:
        return None
    cells = texts.mapInArrow(_scored(model), "h long, cells array<long>").dropDuplicates(["h"])
    counts = cells.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()
    model["threshold"] = thresholds({r["cell"]: r["count"] for r in counts})
    del model["folds"]
    return model


def _find(model, with_text: bool):
    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                base, spans = find(t or "", model)
                n = np.bincount([k for _, k, _ in base], minlength=4).tolist()
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), redact(t or "", spans) if with_text else None))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"],
            )

    return run


def personal_data(docs: DataFrame, sample: int = SAMPLE, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone
    (base spans), base_sha256, spans (base and added ones), redacted (null
    unless ``with_text``).

    Null text counts as empty; texts without spans have the digest of the
    empty string and no spans. Equal texts get equal spans. Offsets are code
    points, ends exclusive. Without base spans to learn from nothing is
    added. An empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _find(model, with_text),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string",
    )
