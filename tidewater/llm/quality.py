"""Quality classifier: a byte-level convolutional network (operator 2).

Bytes are embedded, learned filters slide over the whole document, and each
filter's response is max-pooled over overlapping chunks. The maximum and the
mean over a document's chunks go through one hidden layer into a probability.
The network is trained in numpy on a bounded sample of labelled documents
and applied to every whole text.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 10, 2, 32, 16
HOP = 256  # a chunk is two hops long, and the next one starts a hop later
SLAB = 256 * HOP  # bytes that are convolved at a time
SAMPLE = 2500  # labelled documents that are learned from, at most
SAMPLE_BYTES = 16 * HOP  # of a training document; scoring reads all of it
STEPS, BATCH, RATE = 900, 32, 4e-3
FOLDS, HELD_OUT = 5, 0


def init_model(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embed": normal(256, EMBED, scale=0.5),
        "filters": normal(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, 1, scale=HIDDEN**-0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def _windows(m: dict, data: np.ndarray) -> np.ndarray:
    """Filter responses of the windows that start in ``data``'s first bytes,
    a multiple of HOP; the tail is the overhang of the last window."""
    x = np.ascontiguousarray(m["embed"][data])
    n = (len(data) - (WIDTH - STRIDE)) // STRIDE
    step = x.strides[0]
    return np.lib.stride_tricks.as_strided(x, (n, WIDTH * EMBED), (STRIDE * step, x.strides[1])) @ m["filters"]


def _hop_maxima(m: dict, data: np.ndarray, where: bool = False):
    """Per hop and filter the largest response, and the window it is at."""
    size = max(len(data), 1)
    hops = -(-size // HOP)
    padded = np.zeros(hops * HOP + WIDTH - STRIDE, np.uint8)
    padded[: len(data)] = data
    best = []
    for at in range(0, hops * HOP, SLAB):
        end = min(at + SLAB, hops * HOP)
        r = _windows(m, padded[at : end + WIDTH - STRIDE])
        r[max(0, -(-(size - at) // STRIDE)) :] = -np.inf  # windows of padding alone
        best.append(r.reshape(-1, HOP // STRIDE, FILTERS))
    r = best[0] if len(best) == 1 else np.concatenate(best) if where else None
    if where:
        at = r.argmax(axis=1)
        top = np.take_along_axis(r, at[:, None, :], 1)[:, 0]
        return top, at + np.arange(hops)[:, None] * (HOP // STRIDE), padded
    return np.concatenate([x.max(axis=1) for x in best]), None, padded


def _pooled(m: dict, top: np.ndarray):
    """Chunk features and, for training, which hop each came from."""
    if len(top) > 1:
        later = top[1:] > top[:-1]
        chunk = np.where(later, top[1:], top[:-1])
        origin = np.arange(len(top) - 1)[:, None] + later
    else:
        chunk, origin = top, np.zeros(top.shape, int)
    return np.maximum(chunk + m["bias"], 0), origin


def document_score(m: dict, text: str | None) -> float:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    top, _, _ = _hop_maxima(m, data)
    chunk, _ = _pooled(m, top)
    z = np.concatenate([chunk.max(axis=0), chunk.mean(axis=0)])
    h = np.maximum(z @ m["hidden"] + m["hidden_bias"], 0)
    return float(1 / (1 + np.exp(-np.clip((h @ m["out"] + m["out_bias"])[0], -30, 30))))


def _gradients(m: dict, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    docs, feats = [], []
    for data in texts:
        top, at, padded = _hop_maxima(m, data, where=True)
        chunk, origin = _pooled(m, top)
        first = chunk.argmax(axis=0)
        docs.append((at, padded, chunk, origin, first))
        feats.append(np.concatenate([chunk.max(axis=0), chunk.mean(axis=0)]))
    z = np.stack(feats)
    pre = z @ m["hidden"] + m["hidden_bias"]
    h = np.maximum(pre, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ m["out"] + m["out_bias"], -30, 30)))
    d = (p - labels[:, None]) / len(labels)
    g = {k: np.zeros_like(v) for k, v in m.items()}
    g["out"], g["out_bias"] = h.T @ d, d.sum(axis=0)
    dh = (d @ m["out"].T) * (pre > 0)
    g["hidden"], g["hidden_bias"] = z.T @ dh, dh.sum(axis=0)
    dz = dh @ m["hidden"].T
    cols = np.arange(FILTERS)
    for (at, padded, chunk, origin, first), row in zip(docs, dz):
        dc = np.repeat(row[None, FILTERS:] / len(chunk), len(chunk), axis=0)
        dc[first, cols] += row[:FILTERS]
        dc *= chunk > 0
        g["bias"] += dc.sum(axis=0)
        window = at[origin, cols[None, :]]  # only the windows that won get a gradient
        span = padded[window[:, :, None] * STRIDE + np.arange(WIDTH)]
        x = m["embed"][span].reshape(len(chunk), FILTERS, WIDTH * EMBED)
        g["filters"] += np.einsum("cf,cfk->kf", dc, x, optimize=True)
        dx = (dc[:, :, None] * m["filters"].T[None]).reshape(-1, EMBED)
        flat = span.ravel()
        for e in range(EMBED):
            g["embed"][:, e] += np.bincount(flat, dx[:, e], 256)
    return g


def train(texts: list[str], labels: list[int], seed: int = 1) -> dict[str, np.ndarray] | None:
    """Adam on the log loss; None unless both labels occur."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    m = init_model(seed)
    y = np.asarray(labels, np.float32)
    m["out_bias"][:] = np.log(y.mean() / (1 - y.mean()))
    data = [np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
    one = {k: np.zeros_like(v) for k, v in m.items()}
    two = {k: np.zeros_like(v) for k, v in m.items()}
    epochs = -(-STEPS // -(-len(data) // BATCH))
    step, total = 0, epochs * -(-len(data) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            part = []
            for i in batch:
                start = int(rng.integers(0, max(1, len(data[i]) - SAMPLE_BYTES + 1)))
                part.append(data[i][start : start + SAMPLE_BYTES])
            g = _gradients(m, part, y[batch])
            step += 1
            rate = RATE * min(1.0, step / 20) * (1 - 0.95 * step / total)
            for k in m:
                one[k] = 0.9 * one[k] + 0.1 * g[k]
                two[k] = 0.99 * two[k] + 0.01 * g[k] ** 2
                m[k] -= (rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return m


def fold(id_col: str):
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """Train on at most ``sample`` labelled documents outside the held-out
    fold, chosen by a hash of their ids. Rows without label or id are left
    out. One task trains on the sample; only the model reaches the driver."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & (fold("doc_id") != HELD_OUT))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(chosen, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    found = rows.coalesce(1).mapInPandas(_train_task, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def _train_task(frames):
    """Trains in one task on the bounded sample."""
    pdf = pd.concat([f for f in frames if len(f)] or [pd.DataFrame({"doc_id": [], "text": [], "quality": []})])
    pdf = pdf.sort_values(["doc_id", "quality"], kind="stable")
    model = train(pdf["text"].tolist(), pdf["quality"].astype(int).tolist())
    yield pd.DataFrame({"model": [pickle.dumps(model)]})


def _score(model):
    def run(batches):
        for b in batches:
            score = [0.5 if model is None else document_score(model, t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(score, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null text is scored as the empty text; a null id is never held out.
    Equal texts get equal scores. Without usable labels of both kinds every
    score is 0.5. An empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, sample)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scored = rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """``docs``, all columns, without the rows that the classifier rejects."""
    model = fit(docs, labels, sample)

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            yield b.filter(pa.array([model is None or document_score(model, t) >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
