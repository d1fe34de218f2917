"""Export archives, read as streams with one input partition each."""

from __future__ import annotations

import gzip
import io
import json
import random
import zipfile

from tidewater.sources import ndjson


def _line(i):
    return json.dumps({"id": i, "pad": "x" * 200})


def test_archives_are_told_by_content_and_read_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text(_line(1) + "\n" + _line(2))
    (tmp_path / "b.json.gz").write_bytes(gzip.compress((_line(3) + "\n").encode()))
    (tmp_path / "c").write_bytes(gzip.compress((_line(4) + "\n").encode()) + gzip.compress(_line(5).encode()))  # two members
    with zipfile.ZipFile(tmp_path / "d e%20.zip", "w") as z:
        z.writestr("first.json", _line(6) + "\r\n\r\n" + _line(7))
        z.writestr("second.json", _line(8))
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    (tmp_path / "nothing").write_bytes(b"")  # Spark lists no empty files
    plain, packed = ndjson._archives(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in plain] == ["a.json", "b.json.gz"] and len(packed) == 3
    lines = ndjson.read_archive_lines(spark, packed)
    assert lines.rdd.getNumPartitions() == 3
    got = ndjson.scan_ndjson_export(spark, str(tmp_path)).selectExpr("try_variant_get(record, '$.id', 'int') as id")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_an_archive_is_read_batch_by_batch():
    packed, rng = io.BytesIO(), random.Random(1)
    with gzip.GzipFile(fileobj=packed, mode="wb", compresslevel=1) as z:
        for _ in range(60_000):
            z.write((rng.randbytes(60).hex() + "\n").encode())  # beyond the decoder's own buffer
    size = packed.tell()
    packed.seek(0)
    batches = ndjson.line_batches("x", ndjson.decoded_lines(packed))
    first = next(batches)
    assert first.num_rows == ndjson.BATCH_LINES and packed.tell() < size / 2
    assert first.num_rows + sum(b.num_rows for b in batches) == 60_000


def test_long_lines_end_a_batch_early(monkeypatch):
    monkeypatch.setattr(ndjson, "BATCH_BYTES", 1000)
    assert [b.num_rows for b in ndjson.line_batches("x", iter(["y" * 600] * 5))] == [2, 2, 1]
    assert list(ndjson.line_batches("x", iter([]))) == []


def test_no_archives(spark, tmp_path):
    assert ndjson.read_archive_lines(spark, str(tmp_path)).collect() == []
