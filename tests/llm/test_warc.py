"""WARC archives: exact round trips, revisits, the normaliser."""

import gzip
import hashlib
import io
import random

import pyarrow.fs as pafs

import ledgerlark.llm.warc as warc
from ledgerlark.llm.warc import _inflated, _Reader, archive_round_trip, fields, normalise, read_member, record, write_archives

PAGES = "page_id long, url string, html string, path string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)


def test_round_trip_and_revisits(spark):
    big, other = "<p>é</p>" * 200, "\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a/ b\r\nX: y", big), (5, None, big), (3, "u", big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""),
            (8, "u", other), (9, "u", other), (None, "u", big), (None, "u", "z" * 1500), (None, "u", "z" * 1500), (10, "u", "y" * 1000), (11, "u", "y" * 1000),
            (12, "u", "y" * 999), (13, "u", "y" * 999), (14, "u", "q" * 2000), (14, "u", "q" * 2000)]
    out = sorted((tuple(r) for r in archive_round_trip(frame(spark, rows)).collect()), key=str)

    def line(i, html, kind, to):
        b = (html or "").encode()
        return (i, len(b), hashlib.sha1(b).hexdigest(), kind, to)

    kinds = {1: ("revisit", 5), 3: ("revisit", 5), 8: ("revisit", 9), 10: ("revisit", 11)}
    expected = [line(i, h, *(("revisit", 5) if i is None and h == big else kinds.get(i, ("response", None)))) for i, _, h in rows]
    assert out == sorted(expected, key=str)
    assert archive_round_trip(frame(spark, [])).count() == 0


def test_several_archives_and_index(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    rows = [(i, "u", "".join(rng.choice("abc \n") for _ in range(rng.randrange(0, 5000)))) for i in range(300)]
    files = write_archives(frame(spark, rows).repartition(3), str(tmp_path / "mono"))
    assert files.count() == 3 and sum(r.records for r in files.collect()) == 300
    for r in files.collect():
        assert gzip.decompress(open(r.path, "rb").read()).count(b"WARC/1.1\r\nWARC-Type: response") == r.records
    index = normalise(files, str(tmp_path / "members")).collect()
    assert len(index) == 300
    for path in {r.path for r in index}:
        data = open(path, "rb").read()
        own = sorted((r for r in index if r.path == path), key=lambda r: r.seq)
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(own, own[1:])) and own[-1].offset + own[-1].length == len(data)
        side = open(path.removesuffix(".warc.gz") + ".idx").read().splitlines()
        assert side == [f"{r.offset} {r.length} {r.record_type} {r.record_id}" for r in own]
        for r in own:
            f, _, payload = read_member(data[r.offset : r.offset + r.length])
            assert f["warc-record-id"] == r.record_id and payload == rows[int(f["x-page-id"])][2].encode()


def test_reader_takes_any_pieces_and_members():
    records = [record(i, "u", bytes([65 + i]) * n, hashlib.sha1(bytes([65 + i]) * n).hexdigest(), "response", None) for i, n in enumerate([0, 5, 70_000, 3])]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        for piece in (1, 7, 1 << 20):
            old, warc.PIECE = warc.PIECE, piece if len(data) < 2000 or piece > 1 else 64
            try:
                reader, got = _Reader(_inflated(io.BytesIO(data))), []
                while (head := reader.head()) is not None:
                    got.append(head + b"".join(reader.take(int(fields(head)["content-length"]))) + b"\r\n\r\n")
            finally:
                warc.PIECE = old
            assert got == records


def test_uri_folders(tmp_path):
    fs, base = warc.file_system(f"file://{tmp_path}")
    assert isinstance(fs, pafs.LocalFileSystem) and base == str(tmp_path)
