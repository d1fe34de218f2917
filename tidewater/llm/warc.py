"""WARC archives as a chunked record table (operator 4).

Writing: each task streams its records into gzip members of one archive and
starts the next archive at a size limit. A payload goes through the
compressor in chunks, never copied as a whole record. Of equal payloads one
record is a response, the others are revisits that refer to it. A task that
is run again writes files of its own; only those of the attempt that counted
are in the returned list.

Reading: each archive is read as a stream; a record comes out as rows of
record identifier and chunk number, each with the SHA-1 and length of the
payload up to and including that chunk, so a record of any size needs the
memory of one chunk.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import land
from tidewater.llm.store import filesystem
from tidewater.session import scratch_path

MIN_REVISIT = 1000  # bytes from which equal payloads are written once
CHUNK = 1 << 16
ARCHIVE = 64 << 20  # compressed bytes after which an archive is closed
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6f2f2c5e-3b0c-4a55-9a39-0f6a2a9f7c11")
FILES = "path string, records long, bytes long"
CHUNKS = (
    "record_id string, page_id long, record_type string, refers_to long, url string, chunk_no int, "
    "is_last boolean, digest_so_far string, bytes_so_far long, stated_bytes long, stated_digest string, chunk binary"
)


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with payload facts and the decision response or revisit."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html).alias("digest"),
        F.sha2(html, 256).alias("digest2"),
        F.octet_length(html).cast("long").alias("n"),
    )
    large = keyed.where(F.col("n") >= min_revisit)
    groups = land(
        large.groupBy("digest", "digest2").agg(F.max("page_id").alias("top"), F.count("*").alias("c")).where("c > 1").drop("c"),
        "warc-groups",
    )
    # The group only holds where the payload is large enough to be in one.
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return keyed.join(groups, ["digest", "digest2"], "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        "n",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("top")).alias("refers_to"),
    )


def record_uuid(page_id: int | None, ordinal: str) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{ordinal}')}"


def _clean(url: str) -> str:
    """A header value is one line of printable characters."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url)


class _Archive:
    def __init__(self, folder: str, name: str):
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        self.path, self.records, self.size = f"{folder}/{name}", 0, 0
        self.out = fs.open_output_stream(f"{path}/{name}", compression=None)

    def add(self, head: list[str], body_head: bytes, payload: memoryview) -> None:
        """One gzip member per record, as readers that seek expect it."""
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        length = len(body_head) + len(payload)
        top = "\r\n".join(["WARC/1.1", *head, f"Content-Length: {length}"]) + "\r\n\r\n"
        self._put(z.compress(top.encode() + body_head))
        for at in range(0, len(payload), CHUNK):
            self._put(z.compress(payload[at : at + CHUNK]))
        self._put(z.compress(b"\r\n\r\n") + z.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.size


def _write(folder: str, date: str, limit: int):
    def run(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        archive, done, ordinal = None, [], 0
        for b in batches:
            for r in b.to_pylist():
                if archive is None:
                    archive = _Archive(folder, f"{name}-{len(done):04d}.warc.gz")
                ordinal += 1
                payload = r["html"].encode()
                sha1 = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                head = [
                    f"WARC-Type: {r['record_type']}",
                    f"WARC-Record-ID: <{record_uuid(r['page_id'], f'{task.partitionId()}/{ordinal}')}>",
                    f"WARC-Date: {date}",
                    f"WARC-Payload-Digest: sha1:{sha1}",
                    f"X-Payload-Length: {r['n']}",
                    "Content-Type: application/http; msgtype=response",
                ]
                if r["url"]:
                    head.append(f"WARC-Target-URI: {_clean(r['url'])}")
                if r["page_id"] is not None:
                    head.append(f"X-Page-ID: {r['page_id']}")
                if r["record_type"] == "revisit":
                    head += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-ID: {r['refers_to']}"]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                archive.add(head, http.encode(), memoryview(payload)[: 0 if r["record_type"] == "revisit" else None])
                if archive.size >= limit:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        cols = list(zip(*done)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"]
        )

    return run


def write_warc(
    pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE
) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); returns the
    archives: path, records, bytes. Null html is the empty payload; null urls
    and ids are left out of the header. Repeated rows are records of their
    own; those with the largest id of their payload are all responses. An
    empty table writes no archive. Other columns are ignored."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return land(records(pages, min_revisit).mapInArrow(_write(folder, date, archive_bytes), FILES), "warc-files")


class _Members:
    """Bytes of an archive's gzip members, unpacked as they are asked for."""

    def __init__(self, stream):
        self.stream, self.z, self.rest, self.plain = stream, None, b"", bytearray()

    def _more(self) -> bool:
        if self.z is None or self.z.eof:
            left = self.rest if self.z is None else self.z.unused_data
            left = left or self.stream.read(CHUNK)
            if not left:
                return False
            self.z, self.rest = zlib.decompressobj(31), left
        data, self.rest = self.rest or self.z.unconsumed_tail or self.stream.read(CHUNK), b""
        if not data:
            raise ValueError("archive ends inside a record")
        self.plain += self.z.decompress(data, CHUNK)
        return True

    def line(self) -> bytes | None:
        while (at := self.plain.find(b"\r\n")) < 0:
            if not self._more():
                return bytes(self.plain) or None
        out = bytes(self.plain[:at])
        del self.plain[: at + 2]
        return out

    def take(self, most: int) -> bytes:
        while not self.plain:
            if not self._more():
                raise ValueError("archive ends inside a record")
        out = bytes(self.plain[:most])
        del self.plain[:most]
        return out

    def fields(self) -> dict[str, str]:
        out: dict[str, str] = {}
        while line := self.line():
            name, _, value = line.decode().partition(":")
            out[name.strip().lower()] = value.strip()
        return out


def chunks_of(stream, chunk: int = CHUNK):
    """Rows of the chunk table (see CHUNKS) for one open archive."""
    src = _Members(stream)
    while (line := src.line()) is not None:
        if not line:
            continue
        if line != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = src.fields()
        left = int(head["content-length"])
        before = 0  # bytes of the HTTP head
        while True:
            got = src.line()
            before += len(got) + 2
            if not got:
                break
        left -= before
        sha1, size, number = hashlib.sha1(), 0, 0
        base = (
            head["warc-record-id"].strip("<>"),
            int(head["x-page-id"]) if "x-page-id" in head else None,
            head["warc-type"],
            int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
            head.get("warc-target-uri"),
        )
        stated = int(head["x-payload-length"]), base64.b32decode(head["warc-payload-digest"][5:]).hex()
        while True:
            part = bytearray()
            while left and len(part) < chunk:
                got = src.take(min(left, chunk - len(part)))
                part += got
                left -= len(got)
            sha1.update(part)
            size += len(part)
            yield (*base, number, not left, sha1.copy().hexdigest(), size, *stated, bytes(part))
            number += 1
            if not left:
                break
        if base[2] == "response" and (size, sha1.hexdigest()) != stated:
            raise ValueError(f"record {base[0]}: the payload doesn't match its digest")


def _read(payload: bool):
    kinds = [
        pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string(),
        pa.int64(), pa.int64(), pa.string(), pa.binary(),
    ]
    names = [x.split()[0] for x in CHUNKS.split(", ")]

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, local = filesystem(path)
                rows, held = [], 0
                with fs.open_input_stream(local, compression=None) as stream:
                    for row in chunks_of(stream):
                        rows.append(row if payload else (*row[:-1], None))
                        held += len(row[-1])
                        if len(rows) >= 2000 or held >= 8 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    return run


def read_chunks(files: DataFrame, payload: bool = True) -> DataFrame:
    """The chunk table of the archives named in ``files.path``; without
    ``payload`` the chunk column is null. A damaged archive is an error."""
    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.select("path").repartition(n).mapInArrow(_read(payload), CHUNKS)


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A response's digest and length
    are those of the bytes read back; a revisit has those of the payload that
    it stands for."""
    revisit = F.col("record_type") == "revisit"
    return chunks.where("is_last").select(
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
