"""Training-order materialisation (operator 5).

All documents' ids, each followed by an end-of-text id, form one stream in
the order of document ids; every ``length`` ids of it are a sequence. A
keyed Feistel permutation of the sequence numbers, with cycle-walking down to
their exact count, gives each sequence a global slot, so the training order
is random, needs no shuffle buffer and follows from the key alone. Slots are
dealt by range to shard files in which every sequence takes the same number
of bytes: slot ``s`` is found by arithmetic, and a reader resumes anywhere.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import land, partitions
from tidewater.llm.store import filesystem
from tidewater.llm.tokens import encoder
from tidewater.session import scratch_path

LENGTH, EOS = 1024, 50256
SHARD_BYTES = 16 << 20
ROUNDS = 6
MANIFEST = "slot long, sequence long, shard int, shard_offset long, n_tokens int, ids_crc32 long, path string"


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of ``range(n)`` applied to ``x``: a Feistel network over
    the next even number of bits, walked on until the value is below ``n``."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, ROUNDS, dtype=np.uint64)

    def once(v):
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        return (left << np.uint64(half)) | right

    out = once(np.asarray(x, np.uint64))
    while (away := out >= np.uint64(n)).any():
        out[away] = once(out[away])
    return out.astype(np.int64)


def _tokenize(tokenizer, eos: int):
    def run(batches):
        enc = encoder(tokenizer, special_text=True)
        if max(enc.top, eos) > 0xFFFF:
            raise ValueError(f"ids up to {max(enc.top, eos)} don't fit the shards' 16 bits")
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            ids = [np.append(np.frombuffer(enc.ids(t), "<u4"), eos).astype("<u2") for t in b.column(1).to_pylist()]
            at = np.arange(uid, uid + len(ids))
            uid += len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at, pa.int64()),
                    b.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                ],
                names=["uid", "doc_id", "n", "ids"],
            )

    return run


def _starts_of(folder: str):
    """Looks up where documents begin, from the table of their starts that is
    laid out by the task that made their ids; one task's rows are held."""
    import pyarrow.dataset as ds

    fs, path = filesystem(folder)
    task, uids, begins = None, None, None

    def of(uid: np.ndarray) -> np.ndarray:
        nonlocal task, uids, begins
        out = np.empty(len(uid), np.int64)
        for k in np.unique(uid >> 40).tolist():
            if k != task:
                t = ds.dataset(f"{path}/task={k}", filesystem=fs, format="parquet").to_table(columns=["uid", "begin"])
                uids, begins = t.column("uid").to_numpy(), t.column("begin").to_numpy()
                order = np.argsort(uids)
                task, uids, begins = k, uids[order], begins[order]
            own = uid >> 40 == k
            at = np.searchsorted(uids, uid[own])
            if (uids[np.minimum(at, len(uids) - 1)] != uid[own]).any():
                raise ValueError(f"{path}/task={k}: documents without a start")
            out[own] = begins[at]
        return out

    return of


_PART = np.dtype([("slot", "<i8"), ("sequence", "<i8"), ("at", "<i4"), ("n", "<i4")])
_LEVEL = 6  # of compression, for ids that wait on disk


def _split(starts: str, length: int, total: int, key: int, per_shard: int):
    """Documents to parts of sequences. A row holds the parts that a batch has
    for one shard: ``parts`` of them, described one by one before their ids."""
    count = -(-total // length)

    def run(batches):
        codec, begin_of = pa.Codec("zstd", _LEVEL), _starts_of(starts)
        for b in batches:
            sequences, ats, parts = [], [], []
            begins = begin_of(b.column(0).to_numpy())
            for start, ids in zip(begins.tolist(), b.column(1)):
                ids = memoryview(ids.as_buffer())
                n = len(ids) // 2
                first = start // length
                for s in range(first, (start + n - 1) // length + 1):
                    lo, hi = max(0, s * length - start), min(n, (s + 1) * length - start)
                    sequences.append(s)
                    ats.append(start + lo - s * length)
                    parts.append(ids[2 * lo : 2 * hi])
            about = np.empty(len(parts), _PART)
            about["sequence"], about["at"], about["n"] = sequences, ats, [len(p) // 2 for p in parts]
            about["slot"] = feistel(about["sequence"].astype(np.uint64), count, key) if parts else 0
            shard = about["slot"] // per_shard
            order = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1)) if parts else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                of = order[lo:hi]
                data = about[of].tobytes() + b"".join(parts[i] for i in of.tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[of[0]])], pa.int32()),
                        pa.array([len(of)], pa.int32()),
                        pa.array([len(data)], pa.int64()),
                        pa.array([codec.compress(data, asbytes=True)], pa.binary()),
                    ],
                    names=["shard", "parts", "bytes", "data"],
                )

    return run


def _write(folder: str, length: int, per_shard: int, total: int, eos: int):
    """Parts, sorted by shard, to shard files. One shard is put together in
    memory at a time. A file gets its name when it is whole, so a task that is
    run again replaces nothing half-done."""
    count = -(-total // length)

    def run(batches):
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        codec = pa.Codec("zstd", _LEVEL)
        shard, ids, held, sequence = None, None, None, None

        def close() -> pa.RecordBatch:
            slots = shard * per_shard + np.arange(len(ids))
            want = np.minimum(length, total - sequence * length)
            if (held != want).any():
                raise ValueError(f"shard {shard}: ids missing or repeated in slots {slots[held != want][:5].tolist()}")
            temp, name = f"{path}/_{uuid.uuid4().hex}", f"shard-{shard:06d}.u16"
            with fs.open_output_stream(temp) as out:
                out.write(memoryview(ids).cast("B"))
            fs.move(temp, f"{path}/{name}")
            cols = [
                pa.array(slots, pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(np.full(len(ids), shard), pa.int32()),
                pa.array(np.arange(len(ids)) * 2 * length, pa.int64()),
                pa.array(held, pa.int32()),
                pa.array([zlib.crc32(row) for row in ids], pa.int64()),
                pa.array([f"{folder}/{name}"] * len(ids), pa.string()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in MANIFEST.split(", ")])

        for b in batches:
            for k, n, size, packed in zip(*(c.to_pylist() for c in b.columns)):
                if k != shard:
                    if shard is not None:
                        yield close()
                    shard, rows = k, min(per_shard, count - k * per_shard)
                    ids = np.full((rows, length), eos, "<u2")
                    held, sequence = np.zeros(rows, np.int64), np.full(rows, -1)
                data = codec.decompress(packed, size, asbytes=True)
                about, values = np.frombuffer(data, _PART, n), np.frombuffer(data, "<u2", offset=n * _PART.itemsize)
                row, ends = about["slot"] - k * per_shard, np.cumsum(about["n"])
                for r, at, m, end in zip(row.tolist(), about["at"].tolist(), about["n"].tolist(), ends.tolist()):
                    ids[r, at : at + m] = values[end - m : end]
                np.add.at(held, row, about["n"])
                sequence[row] = about["sequence"]
        if shard is not None:
            yield close()

    return run


def document_starts(tokens: DataFrame) -> DataFrame:
    """``(uid, begin)``: where each row's ids begin in the stream that is
    ordered by (doc_id, uid). Counts are summed by ranges of the order; no
    task sorts more than a range."""
    spark = tokens.sparkSession
    order = ["doc_id", "uid"]
    ranged = land(
        tokens.select("uid", "doc_id", "n").repartitionByRange(partitions(spark), *order)
        .withColumn("part", F.spark_partition_id()),
        "order-ranges",
    )
    sums = ranged.groupBy("part").agg(F.sum("n").alias("sum"))
    # One row per range: as many as there are partitions.
    before = sums.withColumn("before", F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranged.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(land(before.select("part", F.coalesce("before", F.lit(0)).alias("before")), "order-sums"), "part")
        .select("uid", (F.col("before") + F.col("inside")).alias("begin"))
    )


def materialise(
    docs: DataFrame,
    folder: str | None = None,
    key: int = 20240607,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    tokenizer: str | None = None,
    eos: int = EOS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the shards and return their manifest, one row per sequence: slot,
    sequence, shard, shard_offset (bytes), n_tokens (before padding),
    ids_crc32 (of the stored sequence), path.

    Null and empty texts are an end-of-text id alone. Rows that repeat an id
    follow each other; null ids come first. The last sequence is padded with
    end-of-text ids. An empty table writes no shard and gives no rows; other
    columns are ignored. Ids are stored as little-endian unsigned 16-bit
    numbers.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "training-order")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = land(rows.mapInArrow(_tokenize(tokenizer, eos), "uid long, doc_id long, n long, ids binary"), "order-tokens", _LEVEL)
    total = tokens.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], MANIFEST)
    per_shard = max(1, shard_bytes // (2 * length))
    shards = -(-(-(-total // length)) // per_shard)
    tasks = min(shards, partitions(spark) * 4)
    # Starts are laid out by the task that made the ids, so those, the bulk of
    # the data, are shuffled only once: to their shards.
    starts = scratch_path(spark, "order-starts")
    by_task = document_starts(tokens).withColumn("task", F.shiftright("uid", 40))
    by_task.repartition("task").write.option("compression", "zstd").partitionBy("task").parquet(starts)
    parts = tokens.select("uid", "ids").mapInArrow(
        _split(starts, length, total, key, per_shard), "shard int, parts int, bytes long, data binary"
    )
    dealt = parts.withColumn("to", F.floor(F.col("shard") * F.lit(tasks) / F.lit(shards)).cast("int"))
    return land(
        dealt.repartitionById(tasks, F.col("to")).drop("to").sortWithinPartitions("shard")
        .mapInArrow(_write(folder, length, per_shard, total, eos), MANIFEST),
        "order-manifest",
    )


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """``count`` sequences from slot ``first`` on, as a reader resumes."""
    per_shard = max(1, shard_bytes // (2 * length))
    fs, path = filesystem(folder)
    out = []
    while count:
        shard, at = divmod(first, per_shard)
        n = min(count, per_shard - at)
        with fs.open_input_file(f"{path}/shard-{shard:06d}.u16") as f:
            f.seek(at * 2 * length)
            out.append(np.frombuffer(f.read(n * 2 * length), "<u2").reshape(n, length))
        first, count = first + n, count - n
    return np.concatenate(out) if out else np.empty((0, length), "<u2")
