"""Line deduplication by content-defined chunks of lines.

A document's lines (split at ``\\n``) are hashed; a rolling hash over ``span``
consecutive line hashes is taken at every line, and a chunk ends where that value
is a local minimum among its ``reach`` neighbours on either side.  The boundary
depends only on nearby lines, so a passage that moves to another place is cut the
same way inside, and chunks have ``reach + 1`` lines or more except at the ends.

Chunks of two lines or more are counted by hash over the whole corpus (map-side
combined, so a chunk in a third of all documents is one row per task).  A chunk
that an earlier document (smaller doc_id) holds too is a candidate; the bytes of
both are fetched and compared by an equality join, which AQE can split.  Confirmed
chunks go; the first document keeps its own.  Inside one document the first of
equal chunks stays.

*Whole runs* (``runs``, as the query and the pipeline use it).  Both ends of a repeated
passage are cut by what stands beside it, so short ones share no chunk.  Instead of the
chunks every two consecutive lines are then counted, and the SHA-256 of both sides is
compared.  A run of two lines or more stands in earlier documents just if each of its pairs
does, so every line of every repeated run goes.  Inside one document chunks still decide.

Defined results: null text stays null with no lines; an empty text has one empty
line.  Null doc_id counts as the last document.  Rows that repeat doc_id and text
get the same result and rows that share a doc_id do not count as earlier for one
another.  Other columns pass through untouched by the stage function.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, columns_as, cut, discard, release_shuffles, text_slices
from ledgerlark.llm.textnum import fold, hash_spans

SPAN, REACH = 2, 1
#: Null doc_ids sort after every document.
LAST = 2**63 - 1


def _lines(buf: np.ndarray, offs: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first line of each row): bytes between line breaks, none for null rows."""
    breaks = np.flatnonzero(buf == 10)
    n = np.searchsorted(breaks, offs)
    ends = np.sort(np.concatenate([breaks, offs[1:]]), kind="stable")
    starts = np.sort(np.concatenate([breaks + 1, offs[:-1]]), kind="stable")
    first = n + np.arange(len(offs))
    if null.any():
        keep = np.repeat(~null, np.diff(first))
        starts, ends = starts[keep], ends[keep]
        first = np.concatenate([[0], np.cumsum(np.where(null, 0, np.diff(first)))])
    return starts, ends, first


def chunk_bounds(hashes: np.ndarray, span: int = SPAN, reach: int = REACH) -> np.ndarray:
    """Line indices at which the chunks of one document start, with the line count at the end."""
    n, roll = len(hashes), fold(hashes, span)   # roll[i] covers lines i .. i + span - 1
    if not n:
        return np.zeros(1, np.int64)
    low = np.ones(len(roll), bool)
    for j in range(1, reach + 1):
        low[j:] &= roll[j:] < roll[:-j]
        low[:-j] &= roll[:-j] <= roll[j:]
    low[:reach] = False   # a boundary needs its neighbours; the ends of a document are none
    low[len(roll) - reach :] = False
    return np.concatenate([[0], np.flatnonzero(low) + span - 1, [n]])


def _chunks(texts: pa.Array, span: int, reach: int):
    """Per row: (row, starts, ends, line hashes, chunk bounds, text bytes)."""
    null = np.asarray(texts.is_null())
    for lo, buf, offs in text_slices(texts):
        starts, ends, first = _lines(buf, offs, null[lo : lo + len(offs) - 1])
        h = hash_spans(buf, starts, ends)
        for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            yield lo + r, starts[a:b], ends[a:b], h[a:b], chunk_bounds(h[a:b], span, reach), buf


def _chunk_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each chunk's line hashes in order."""
    return np.array([fold(h[a:b], b - a)[0] for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b > a], np.uint64).view(np.int64)


def _units(h: np.ndarray, bounds: np.ndarray, runs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first lines, lines after the last) of a document's pairs of lines, or of its chunks of two lines or more."""
    if runs:
        at = np.arange(max(0, len(h) - 1))
        return fold(h, 2).view(np.int64), at, at + 2
    wide = np.flatnonzero(np.diff(bounds) >= 2)
    return _chunk_hashes(h, bounds)[wide], bounds[wide], bounds[wide + 1]


def _chunk_rows(span: int, reach: int, runs: bool):
    schema = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("hash", pa.int64())])

    def run(batches):
        for batch in batches:
            rows, hashes = [], []
            for r, _, _, h, bounds, _ in _chunks(batch.column("text"), span, reach):
                if len(h) >= 2:
                    c = np.unique(_units(h, bounds, runs)[0])
                    rows.append(np.full(len(c), r)), hashes.append(c)
            take = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("did").take(take), batch.column("th").take(take),
                                              pa.array(np.concatenate(hashes) if hashes else np.empty(0, np.int64))], schema=schema)

    return run


def _chunk_texts(span: int, reach: int, runs: bool):
    """Rows (did, th, text, hashes) to the bytes of the chunks with those hashes, or the SHA-256 of the pairs."""
    schema = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("hash", pa.int64()), ("chunk", pa.binary())])

    def run(batches):
        for batch in batches:
            asked = batch.column("hashes")
            rows, hashes, parts = [], [], []
            for r, starts, ends, h, bounds, buf in _chunks(batch.column("text"), span, reach):
                if len(h) < 2:
                    continue
                c, lo, hi = _units(h, bounds, runs)
                for i in np.flatnonzero(np.isin(c, asked[r].values.to_numpy())):
                    part = buf[starts[lo[i]] : ends[hi[i] - 1]].tobytes()
                    rows.append(r), hashes.append(c[i])
                    parts.append(hashlib.sha256(part).digest() if runs else part)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("did").take(take), batch.column("th").take(take),
                                              pa.array(hashes, pa.int64()), pa.array(parts, pa.binary())], schema=schema)

    return run


def _apply(span: int, reach: int, runs: bool):
    """Rows (doc_id, text, gone) to the remaining text and line counts."""
    schema = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])

    def run(batches):
        for batch in batches:
            texts, gone = batch.column("text"), batch.column("gone")
            out, total, removed = [], [], []
            for r, starts, ends, h, bounds, buf in _chunks(texts, span, reach):
                total.append(len(h))
                found = gone[r].as_py() or ()
                bad = set(() if runs else found)
                size, c = np.diff(bounds), _chunk_hashes(h, bounds) if len(h) else np.empty(0, np.int64)
                drop, seen = np.zeros(len(h), bool), {}
                if bad or len(np.unique(c[size >= 2])) < int((size >= 2).sum()):
                    for i in np.flatnonzero(size >= 2):
                        part = buf[starts[bounds[i]] : ends[bounds[i + 1] - 1]].tobytes()
                        if int(c[i]) in bad or part in seen.setdefault(int(c[i]), set()):
                            drop[bounds[i] : bounds[i + 1]] = True
                        seen.setdefault(int(c[i]), set()).add(part)
                if runs and found:
                    pairs, lo, _ = _units(h, bounds, runs)
                    lo = lo[np.isin(pairs, np.array(found, np.int64))]
                    drop[lo] = drop[lo + 1] = True
                removed.append(int(drop.sum()))
                if removed[-1]:
                    out.append(b"\n".join(buf[starts[i] : ends[i]].tobytes() for i in np.flatnonzero(~drop)).decode("utf-8"))
                else:
                    out.append(texts[r].as_py())
            yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("th"), pa.array(out, pa.string()),
                                              pa.array(total, pa.int64()), pa.array(removed, pa.int64())], schema=schema)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    docs = columns_as(docs, "doc_id", "text")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"), F.xxhash64("text").alias("th"), "text")


def _removals(keyed: DataFrame, span: int, reach: int, runs: bool) -> DataFrame:
    """(did, th, gone): the hashes of the chunks or pairs that each document loses to an earlier one."""
    spark = keyed.sparkSession
    chunks = cut(arrow_map(keyed, _chunk_rows(span, reach, runs), "did long, th long, hash long"), "chunks")
    # Written before the join: a join of two plain exchanges lets AQE split a chunk that occurs everywhere.
    common = cut(chunks.groupBy("hash").agg(F.min("did").alias("first"), F.max("did").alias("last"))
                 .where("first <> last").select("hash", "first"), "common")
    spots = cut(chunks.join(common, "hash"), "spots")
    asked = spots.groupBy("did", "th").agg(F.collect_list("hash").alias("hashes"))
    # Texts are joined by sort-merge at every size, so that cost grows in proportion.
    texts = cut(arrow_map(keyed.join(asked.hint("merge"), ["did", "th"]).select("did", "th", "text", "hashes"),
                          _chunk_texts(span, reach, runs), "did long, th long, hash long, chunk binary").distinct(), "texts")
    release_shuffles(spark)
    first = spots.where("did = first").select("did", "hash").distinct()
    originals = cut(texts.join(first, ["did", "hash"], "left_semi").select("hash", "chunk").distinct(), "originals")
    later = texts.join(spots.where("did > first").select("did", "th", "hash").distinct(), ["did", "th", "hash"], "left_semi")
    same = later.join(originals, ["hash", "chunk"], "left_semi")   # equality of the bytes
    gone = cut(same.groupBy("did", "th").agg(F.collect_set("hash").alias("gone")), "gone")
    discard(chunks, common, spots, texts, originals)
    return gone


def dedup_lines(docs: DataFrame, span: int = SPAN, reach: int = REACH, runs: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, text without repeated chunks (``runs``: without any line of a repeated run), n_lines, n_removed."""
    keyed = _keyed(docs)
    gone = _removals(keyed, span, reach, runs)
    release_shuffles(docs.sparkSession)
    out = arrow_map(keyed.join(gone.hint("merge"), ["did", "th"], "left").select("did", "th", "text", "gone"), _apply(span, reach, runs),
                    "did long, th long, text string, n_lines long, n_removed long")
    return out.select(F.when(F.col("did") != LAST, F.col("did")).alias("doc_id"), "text", "n_lines", "n_removed")


def drop_repeated_lines(docs: DataFrame, span: int = SPAN, reach: int = REACH, runs: bool = False) -> DataFrame:
    """The documents with the text that is left, all columns kept; ``n_chars`` follows the text.

    A document that loses every line goes: all it said stands in earlier documents.
    """
    gone = _removals(_keyed(docs), span, reach, runs)
    release_shuffles(docs.sparkSession)
    others = [c for c in docs.columns if c != "text"]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), F.col("text"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"), F.xxhash64("text").alias("th"))
    rest_type = keyed.schema["rest"].dataType.simpleString()
    inner = _apply(span, reach, runs)

    def run(batches):
        for batch in batches:
            for done in inner(iter([batch])):
                keep = pa.array([not (t and t == r) for t, r in zip(done.column("n_lines").to_pylist(), done.column("n_removed").to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("rest"), done.column("text"), done.column("n_removed")],
                                                 names=["rest", "text", "n_removed"]).filter(keep)

    out = arrow_map(keyed.join(gone.hint("merge"), ["did", "th"], "left").select("rest", "did", "th", "text", "gone"), run, f"rest {rest_type}, text string, n_removed long")
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("text"))
        elif c == "n_chars":
            cols.append(F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("rest.n_chars")).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("rest").getField(c).alias(c))
    return out.select(*cols)
