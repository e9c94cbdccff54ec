"""WARC archives: writing, a normaliser for monolithic gzip files, reading back by offset index.

* ``write_archives`` writes one record per page.  Of pages with equal payloads of
  ``REVISIT_FROM`` bytes or more the largest page_id is the response and the others
  are revisits without payload.  Each file is one gzip stream, closed once it holds
  ``ARCHIVE_BYTES`` or more.
* ``normalise`` inflates such a file once from front to back, in pieces, rewrites
  every record as a gzip member of its own and writes a sidecar index
  (``.idx``: offset, length, type, record id per line).  Memory is bounded by the
  piece size, not by the record or the file.
* ``read_archives`` seeks to members by the index and parses them.

Files go to a folder that all executors share, through ``pyarrow.fs``.  Every task
attempt writes files of its own name; only those listed by the attempt that
succeeded are read, and that list is written as a table before anything reads it, so
a lost executor or a repeated task leaves unused files but never a wrong record.

Defined results: null html is an empty payload.  A null url is left out of the
record.  Null page_ids are written without id; in a group of equal payloads they
are revisits, or responses if no page of the group has an id.  Rows that repeat the
largest page_id of a group are all responses.  Extra columns are ignored.  An empty
table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, columns_as, cut, scratch_path

REVISIT_FROM = 1000
ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 20
#: Tasks of a pass over archives, at most; records of an archive that one task reads back.
MOST_TASKS, READ_TOGETHER = 20_000, 1000
_IDS = uuid.UUID("6f1d3f0a-5a0c-4f43-9b0e-8f2f6a5f7c11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and plain path of a folder given as a URI or an absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to of every page."""
    p = columns_as(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload").cast("long"))
    # Written first: usually few, so the planner can broadcast them by their known size.
    groups = cut(p.where(F.col("size") >= REVISIT_FROM).groupBy("digest", "size").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1 and top is not null").select("digest", "size", "top"), "payload-groups")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return p.join(groups, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("top")).alias("refers_to"))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in hex."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as monolithic gzip archives; returns the table of files (path, records)."""
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out = path = None
        n = size = 0
        for batch in batches:
            cols = [batch.column(c) for c in range(6)]
            cols[2] = cols[2].cast(pa.binary())
            for row in zip(*(c.to_pylist() for c in cols), strict=True):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, gz, n, size = fs.open_output_stream(path, compression=None), zlib.compressobj(1, wbits=31), 0, 0
                raw = record(*row)
                out.write(gz.compress(raw))
                n, size = n + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    out.write(gz.flush()), out.close()
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, schema)
                    out = None
        if out is not None:
            out.write(gz.flush()), out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]}, schema)

    typed = with_record_types(pages).select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return cut(arrow_map(typed, run, "path string, records long"), "archives")


def _inflated(source) -> Iterator[bytes]:
    """Pieces of the plain bytes of a gzip file of one or more members."""
    gz = zlib.decompressobj(wbits=31)
    while piece := source.read(PIECE):
        while piece:
            plain = gz.decompress(piece, PIECE)
            if plain:
                yield plain
            piece = gz.unconsumed_tail
            if gz.eof:
                piece, gz = gz.unused_data, zlib.decompressobj(wbits=31)
    if rest := gz.flush():
        yield rest


class _Reader:
    """Reads lines and byte counts from an iterator of pieces."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held += piece
        return bool(piece)

    def head(self) -> bytes | None:
        """The header lines of the next record with the blank line, None at the end."""
        while not self.held.lstrip(b"\r\n") and self._more():
            pass
        self.held = self.held.lstrip(b"\r\n")
        if not self.held:
            return None
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("a record's header does not end")
        out, self.held = self.held[: end + 4], self.held[end + 4 :]
        if not out.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {out[:40]!r}")
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise ValueError("a record is cut short")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file of ``files`` (path) member by member; returns the index
    (path, seq, offset, length, record_type, record_id), which also stands beside each file."""
    schema = pa.schema([("path", pa.string()), ("seq", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("record_type", pa.string()), ("record_id", pa.string())])

    def rewrite(fs, base: str, path: str) -> pa.RecordBatch:
        name, rows, at = f"{base}/{uuid.uuid4().hex}.warc.gz", [], 0
        with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(name, compression=None) as out:
            reader = _Reader(_inflated(source))
            while (head := reader.head()) is not None:
                f, gz, start = fields(head), zlib.compressobj(6, wbits=31), at
                for part in (head, *([] if f["content-length"] == "0" else reader.take(int(f["content-length"]))), b"\r\n\r\n"):
                    data = gz.compress(part)
                    out.write(data)
                    at += len(data)
                data = gz.flush()
                out.write(data)
                at += len(data)
                rows.append((name, len(rows), start, at - start, f["warc-type"], f["warc-record-id"]))
        with fs.open_output_stream(name.removesuffix(".warc.gz") + ".idx", compression=None) as side:
            side.write("".join(f"{r[2]} {r[3]} {r[4]} {r[5]}\n" for r in rows).encode())
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], schema.field(c).type) for c in range(6)], schema=schema)

    def run(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield rewrite(fs, base, path)

    # An explicit number: the rows are short paths, which would be coalesced to a task by their own size.
    one_each = files.select("path").repartition(max(1, min(files.count(), MOST_TASKS)))
    return cut(arrow_map(one_each, run, "path string, seq long, offset long, length long, record_type string, record_id string"), "index")


def read_member(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one gzip member."""
    raw = zlib.decompress(data, wbits=31)
    end = raw.index(b"\r\n\r\n") + 4
    f = fields(raw[:end])
    block = raw[end : end + int(f["content-length"])]
    cut_at = block.index(b"\r\n\r\n") + 4
    return f, fields(block[:cut_at]), block[cut_at:]


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Per indexed record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest and size come from its payload, a revisit's from its header.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        fs, _ = file_system(folder)
        name = source = None
        for batch in batches:
            out: list[tuple] = []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                if path != name:
                    name, source = path, fs.open_input_file(path)
                source.seek(offset)
                f, http, payload = read_member(source.read(length))
                claimed = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                page, to = f.get("x-page-id"), f.get("x-refers-to-page")
                if f["warc-type"] == "response":
                    digest = hashlib.sha1(payload).hexdigest()
                    if digest != claimed:
                        raise ValueError(f"payload and digest differ in {path} at {offset}")
                    size = len(payload)
                else:
                    digest, size = claimed, int(http["content-length"])
                out.append((page and int(page), size, digest, f["warc-type"], to and int(to)))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], schema.field(c).type) for c in range(5)], schema=schema)

    tasks = max(1, min(-(-index.count() // READ_TOGETHER), MOST_TASKS))
    ranges = (index.repartition(tasks, "path", F.floor(F.col("seq") / READ_TOGETHER)).sortWithinPartitions("path", "offset")
              .select("path", "offset", "length"))
    return arrow_map(ranges, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages, normalise the archives and read every record back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    files = write_archives(pages, f"{folder}/monolithic")
    return read_archives(normalise(files, f"{folder}/members"), f"{folder}/members")
