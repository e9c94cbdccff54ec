"""Repeated byte strings by prefix-free parsing.

A string of ``TRIGGER`` bytes whose rolling hash is 0 modulo ``MODULUS`` is a trigger.
Triggers cut every text into phrases, and no proper phrase suffix is the beginning of another, so
in corpus order a suffix is found by its phrase suffix and then by the place of what
follows in the parse.  Two windows of ``length`` bytes are equal only if their next triggers
stand at the same distance; that distance and the bytes about the trigger are the sort key
of the parse, the bytes before it the suffix in the dictionary.  Only equality up to ``length`` bytes
counts here, so neighbours in corpus order are brought together by hash, not by alphabet.

1. *Parse.*  One pass hashes every text (prefix sums, so the hash of any span is one
   subtraction) and counts, for each trigger, the 128 bytes or more that all windows ending their
   phrase suffix there share (the phrase's *tail*).  A tail that occurs once ends it.
2. *Dictionary.*  Phrases with a repeated tail, together with the ``length - 1`` bytes after
   them, are grouped: the dictionary of distinct extended phrases with their number of occurrences and one place.
   One that occurs twice is repeated as a whole: all windows that start in it are settled.
3. *Suffixes.*  What occurs once, and shares its tail with other dictionary entries, is
   opened: its window starts are cut into cells at fixed distances before the trigger, and of cells whose common
   bytes occur twice the windows that start at each suffix are compared with those of the entries
   of the same tail.  Only the edges of repeats get there, and each distinct entry is opened once.
4. *Sparse text.*  Windows without a trigger in reach are compared one by one.
5. A byte goes if a repeated window covers it.

Texts that repeat as a whole share their key, so their runs fold into one set by partial aggregates;
a phrase's occurrences inside one piece of a text are one row with their number.  Texts are read in pieces of ``PIECE`` bytes.
Equality of spans is equality of two 64-bit hashes; texts are told apart by 88 bits of hash.

Defined results: null text is empty.  Every row is a document of its own, whatever its
doc_id: rows that repeat doc_id and text are copies, and rows without doc_id are treated like others.
Texts shorter than ``length`` bytes keep everything.  Extra columns are ignored.  A text may have
up to 2**32 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, cut, discard, release_shuffles, text_buffer
from ledgerlark.llm.textnum import mix

LENGTH, TRIGGER, MODULUS = 200, 12, 32
#: Window starts of a cell, compared as one before its windows are.
CELL = 8
#: Window starts of a text that are hashed at once; bounds the eight-byte temporaries per byte.
PIECE = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(77003))
_VALUE = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F]
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both bases and of their inverses modulo 2**64."""
    if not _powers or len(_powers[0][0]) < n:
        _powers.clear()
        for base in _BASE:
            tables = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                tables.append(np.cumprod(p, dtype=np.uint64))
            _powers.append((tables[0], tables[1]))
    return _powers


class Hashes:
    """Hash of any span of a buffer: ``of(start, end)``, ``second(start, end)`` by other weights."""

    def __init__(self, buf: np.ndarray):
        self.tables = _power_tables(max(len(buf) + 1, 2 * PIECE + 4096))
        self.sums = []
        for value, (power, _) in zip(_VALUE, self.tables, strict=True):
            s = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(value[buf] * power[: len(buf)], out=s[1:])
            self.sums.append(s)

    def _hash(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s, back = self.sums[which], self.tables[which][1]
        return mix((s[end] - s[start]) * back[start] + (end - start).astype(np.uint64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._hash(0, start, end)

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._hash(1, start, end)

    def triggers(self) -> np.ndarray:
        """Start of every trigger of the buffer, whatever text it lies in."""
        s, back = self.sums[0], self.tables[0][1]
        h = (s[TRIGGER:] - s[:-TRIGGER]) * back[: len(s) - TRIGGER]
        return np.flatnonzero((mix(h) >> np.uint64(32)) % np.uint64(MODULUS) == 0)


class Parse:
    """Phrases of consecutive texts: runs of window starts with the trigger that follows them.

    ``row``, ``start``, ``stop``: window starts of the run; ``low``, ``high``: the
    tail that all windows of the run hold (-1: none, sparse text).
    """

    def __init__(self, offs: np.ndarray, starts_until: np.ndarray, length: int, hashes: Hashes):
        ends, begins = offs[1:], offs[:-1]
        t = hashes.triggers()
        row = np.searchsorted(offs, t, "right") - 1
        fits = t + TRIGGER <= ends[row]
        t, row = t[fits], row[fits]
        before = np.concatenate([[0], t[:-1]])
        same = np.concatenate([[False], row[1:] == row[:-1]])
        begin = np.where(same, before, begins[row])                   # first window start whose next trigger is t
        stop = np.minimum(t, starts_until[row])
        reach = length - TRIGGER - 4                                  # furthest a trigger may stand off
        far, limit = length * 8 // 25, min(length * 17 // 25, reach)
        last = begins.copy()
        last[row] = t                                                 # the last trigger of each text
        bands = [   # (nearest run start, run stop, tail from, tail to), as offsets before the trigger
            (0, far, 0, length - far),
            (far, limit, far, length - limit),
            (limit, reach, limit, length - reach),
        ]
        out = []
        for near, deep, low, high in bands:
            a, b = np.maximum(begin, t - deep), np.minimum(stop, t - near)
            ok = a < b
            out.append((row[ok], a[ok], b[ok], (t - low)[ok], (t + high)[ok]))
        a, b = begin, np.minimum(stop, t - reach)
        ok = a < b
        none = np.full(int(ok.sum()), -1)
        out.append((row[ok], a[ok], b[ok], none, none))
        rows = np.arange(len(begins))
        ok = last < starts_until
        none = np.full(int(ok.sum()), -1)
        out.append((rows[ok], last[ok], starts_until[ok], none, none))
        self.row, self.start, self.stop, self.low, self.high = (np.concatenate(c) for c in zip(*out, strict=True))


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the batch, offset in its text, bytes, piece offsets, end of window starts) of about PIECE bytes.

    A long text comes in several pieces that overlap so far that each sees every byte its window
    starts can depend on.
    """
    buf, offs = text_buffer(batch.column("text"))
    rows, ats, parts, untils, size = [], [], [], [], 0

    def flush():
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return np.array(rows), np.array(ats), np.concatenate(parts), bounds, bounds[:-1] + np.array(untils)

    for r in range(batch.num_rows):
        lo, hi = int(offs[r]), int(offs[r + 1])
        windows = hi - lo - length + 1
        for at in range(0, max(windows, 0), PIECE):
            n = min(PIECE, windows - at)
            part = buf[lo + at : min(hi, lo + at + n + 2 * length)]
            rows.append(r), ats.append(at), parts.append(part), untils.append(n)
            size += len(part)
            if size >= PIECE:
                yield flush()
                rows, ats, parts, untils, size = [], [], [], [], 0
    if rows:
        yield flush()


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every position of the runs [start, stop), and the run it is of."""
    n = stop - start
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + start[of], of


def _tails(length: int):
    """Texts to the hash of each phrase's tail, counted within a piece."""
    schema = pa.schema([("tail", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for _, _, buf, offs, until in _pieces(batch, length):
                h = Hashes(buf)
                p = Parse(offs, until, length, h)
                dense = p.low >= 0
                tail, n = np.unique(h.of(p.low[dense], p.high[dense]), return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(tail), pa.array(n)], schema=schema)

    return run


#: kind 0: a phrase (tail, extended phrase); 1: a sparse window (both hashes); 2: window starts known to be repeated, their number in ``first``.
_ENTRY = "kind int, first long, second long, text_hash long, at long, n long"


def _pack(text_bits: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """24 bits of the text's second hash, 32 bits of position, 8 bits of run length."""
    return (text_bits << 40) | (start << 8) | count


def _entries(length: int):
    """Texts to their dictionary entries; what repeats inside one piece is settled here and left once."""
    schema = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("first", "second", "text_hash", "at", "n")]])

    def run(batches):
        for batch in batches:
            text_hash, bits = (batch.column(c).to_numpy() for c in ("text_hash", "bits"))
            for rows, ats, buf, offs, until in _pieces(batch, length):
                h = Hashes(buf)
                p = Parse(offs, until, length, h)
                dense = p.low >= 0
                lone, of = _spread(p.start[~dense], p.stop[~dense])
                kind = np.concatenate([np.zeros(int(dense.sum()), np.int32), np.ones(len(lone), np.int32)])
                row = np.concatenate([p.row[dense], p.row[~dense][of]])
                start = np.concatenate([p.start[dense], lone])
                count = np.concatenate([(p.stop - p.start)[dense], np.ones(len(lone), np.int64)])
                first = np.concatenate([h.of(p.low[dense], p.high[dense]), h.of(lone, lone + length)])
                second = h.second(start, start + count + length - 1)
                order = np.lexsort((start, second, first, row, kind))
                kind, row, start, count, first, second = (a[order] for a in (kind, row, start, count, first, second))
                new = np.ones(len(kind), bool)
                for a in (kind, row, first, second):
                    new[1:] &= a[1:] == a[:-1]
                new[1:] = ~new[1:]
                new[:1] = True
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(kind)))
                again = np.repeat(n, n) > 1
                text = rows[row]
                at = _pack(bits[text], start - offs[row] + ats[row], count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind[head]), _signed(first[head]), _signed(second[head]), pa.array(text_hash[text[head]]), pa.array(at[head]), pa.array(n)], schema=schema)
                if again.any():
                    r, s, c = text[again], start[again] - offs[row[again]] + ats[row[again]], count[again]
                    s, c, r = _runs(r, s, c)
                    zero = np.zeros(len(s), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), 2, np.int32)), pa.array(c), pa.array(zero), pa.array(text_hash[r]), pa.array(_pack(bits[r], s, zero)), pa.array(zero + 1)], schema=schema)

    return run


def _runs(row: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts, merged where they touch: start, count, row."""
    order = np.lexsort((start, row))
    row, start, count = row[order], start[order], count[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[:-1] + count[:-1] != start[1:])
    head = np.flatnonzero(new)
    return start[head], np.add.reduceat(count, head) if len(head) else count, row[head]


def _asked_spans(batches, length: int):
    """Rows (text_hash, bits, text, asked) to (text_hash, bits, start, stop, first byte hashed, Hashes), about a piece at a time.

    Copies of one text that come together are read once.
    """
    seen = None
    for batch in batches:
        text_hash, bits = (batch.column(c).to_numpy() for c in ("text_hash", "bits"))
        buf, offs = text_buffer(batch.column("text"))
        for r in range(batch.num_rows):
            if seen == (text_hash[r], bits[r]):
                continue
            seen = (text_hash[r], bits[r])
            asked = np.sort(batch.column("asked")[r].values.to_numpy() & ((1 << 40) - 1))
            start, stop = asked >> 8, (asked >> 8) + (asked & 255)
            lo = 0
            while lo < len(start):   # entries within one piece
                hi = max(lo + 1, int(np.searchsorted(start, start[lo] + PIECE)))
                base = int(start[lo])
                h = Hashes(buf[offs[r] + base : min(offs[r + 1], offs[r] + int(stop[lo:hi].max()) + length - 1)])
                yield text_hash[r], bits[r], start[lo:hi], stop[lo:hi], base, h
                lo = hi


def _cells(length: int):
    """Asked entries to their cells: CELL window starts counted back from the trigger, with the bytes all of them share (the core)."""
    schema = pa.schema([(c, pa.int64()) for c in ("core", "text_hash", "at")])

    def run(batches):
        for text_hash, bits, start, stop, base, h in _asked_spans(batches, length):
            t = h.triggers() + base
            t = t[np.searchsorted(t, start, "right")]   # the trigger that follows the entry
            cell, of = _spread((t - stop) // CELL, (t - 1 - start) // CELL + 1)
            high = t[of] - cell * CELL
            low = high - CELL
            a, b = np.maximum(start[of], low), np.minimum(stop[of], high)
            yield pa.RecordBatch.from_arrays(
                [_signed(h.of(high - 1 - base, low + length - base)), pa.array(np.full(len(a), text_hash)),
                 pa.array(_pack(np.full(len(a), bits), a, b - a))], schema=schema)

    return run


def _opened(length: int):
    """Asked runs to the windows that start in them."""
    schema = pa.schema([(c, pa.int64()) for c in ("first", "second", "text_hash", "at", "n")])

    def run(batches):
        for text_hash, bits, start, stop, base, h in _asked_spans(batches, length):
            at, _ = _spread(start - base, stop - base)
            one = np.ones(len(at), np.int64)
            yield pa.RecordBatch.from_arrays(
                [_signed(h.of(at, at + length)), _signed(h.second(at, at + length)), pa.array(np.full(len(at), text_hash)),
                 pa.array(_pack(np.full(len(at), bits), at + base, one)), pa.array(one)], schema=schema)

    return run


def covered(runs: np.ndarray, length: int, size: int) -> list[tuple[int, int]]:
    """Byte spans under windows of the runs (start, count), merged."""
    out: list[list[int]] = []
    for start, count in runs[np.argsort(runs[:, 0], kind="stable")].tolist():
        end = min(start + count + length - 1, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _kept(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sizes, gone, n_spans, kept = [], [], [], []
                for i, (text, copy) in enumerate(zip(part.column("text").to_pylist(), part.column("copy").to_pylist(), strict=True)):
                    text, spans = text or b"", []
                    if copy and len(text) >= length:
                        spans = [(0, len(text))]
                    elif part.column("starts")[i].is_valid:
                        starts, counts = (part.column(c)[i].values.to_numpy() for c in ("starts", "counts"))
                        spans = covered(np.stack([starts, counts], axis=1), length, len(text))
                    edges = [0, *[e for s in spans for e in s], len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(text)), gone.append(len(text) - len(kept[-1])), n_spans.append(len(spans))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], schema=schema)

    return run


def _merged():
    """One row per text with its runs of window starts to the same runs merged where they touch."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("text_hash", pa.int64()), ("bits", pa.int64()), ("starts", longs), ("counts", longs)])

    def run(batches):
        for batch in batches:
            n = np.diff(batch.column("runs").offsets.to_numpy())
            flat = batch.column("runs").flatten()   # start and count in one long
            packed = flat.to_numpy()
            start, count, row = _runs(np.repeat(np.arange(batch.num_rows), n), packed >> 24, packed & ((1 << 24) - 1))
            bounds = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_hash"), batch.column("bits"), pa.ListArray.from_arrays(bounds, pa.array(start)), pa.ListArray.from_arrays(bounds, pa.array(count))], schema=schema)

    return run


def _by_text(rows: DataFrame, count) -> DataFrame:
    """Window starts of rows (text_hash, at) by text; copies of a text fold into one set before the shuffle."""
    start = F.shiftright("at", 8).bitwiseAND((1 << 32) - 1)
    sets = (rows.select("text_hash", F.shiftrightunsigned("at", 40).alias("bits"), (F.shiftleft(start, 24) + count).alias("run"))
            .groupBy("text_hash", "bits").agg(F.collect_set("run").alias("runs")))
    return arrow_map(sets, _merged(), "text_hash long, bits long, starts array<long>, counts array<long>")


def repeated_windows(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(text_hash, bits, starts, counts): runs of window starts of each distinct text whose windows also start elsewhere.

    ``texts``: text_hash, bits and text (binary), a row per occurrence.
    """
    spark = texts.sparkSession
    long_enough = texts.where(F.length("text") >= length)
    often = cut(arrow_map(long_enough.select("text"), _tails(length), "tail long, n long").groupBy("tail").agg(F.sum("n").alias("n"))
                .where("n > 1").select("tail", F.lit(True).alias("live")), "tails")
    release_shuffles(spark)
    # One scan of the texts: sparse windows and settled runs ride through the join, spread by other columns.
    entries = arrow_map(long_enough, _entries(length), _ENTRY)
    alive = cut(entries.withColumn("tail", F.when(F.col("kind") == 2, F.col("text_hash")).otherwise(F.col("first")))
                .join(often, "tail", "left").where("kind > 0 or live").drop("tail", "live"), "alive")
    discard(often)
    release_shuffles(spark)

    # The number of occurrences and one of them; both columns of ``first`` are of the same row.
    phrases, rest = alive.where("kind = 0"), cut(alive.where("kind > 0"), "sparse")
    dictionary = cut(phrases.groupBy("first", "second").agg(F.sum("n").alias("n"), F.first("text_hash").alias("text_hash"), F.first("at").alias("at")), "dictionary")
    release_shuffles(spark)
    several = dictionary.where("n > 1").select("first", "second")
    settled = cut(_by_text(phrases.join(several, ["first", "second"], "left_semi"), F.col("at").bitwiseAND(255)), "settled")
    discard(alive)
    release_shuffles(spark)
    # Tails that several entries share, one of them occurring once.
    mixed = cut(dictionary.groupBy("first").agg(F.count(F.lit(1)).alias("entries"), F.min("n").alias("least"))
                .where("entries > 1 and least = 1").select("first"), "mixed")
    asked = cut(dictionary.join(mixed, "first", "left_semi").groupBy("text_hash", F.shiftrightunsigned("at", 40).alias("bits"))
                .agg(F.collect_list("at").alias("asked")), "asked")
    discard(dictionary, mixed)
    release_shuffles(spark)

    # Written in text order, where the text's columns take next to no space.
    def read(asked, fn, shape, label):
        return cut(arrow_map(long_enough.join(asked, ["text_hash", "bits"]).select("text_hash", "bits", "text", "asked"), fn(length), shape), label)

    cells = read(asked, _cells, "core long, text_hash long, at long", "cells")
    discard(asked)
    cores = cut(cells.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "cores")
    asked = cut(cells.join(cores, "core", "left_semi").groupBy("text_hash", F.shiftrightunsigned("at", 40).alias("bits"))
                .agg(F.collect_set("at").alias("asked")), "asked-cells")
    discard(cells, cores)
    release_shuffles(spark)
    opened = read(asked, _opened, "first long, second long, text_hash long, at long, n long", "opened")
    discard(asked)
    release_shuffles(spark)
    windows = opened.unionByName(rest.where("kind = 1").drop("kind"))
    repeated = cut(windows.groupBy("first", "second").agg(F.sum("n").alias("n")).where("n > 1").select("first", "second"), "repeated")
    release_shuffles(spark)
    found = cut(_by_text(windows.join(repeated, ["first", "second"], "left_semi"), F.lit(1)), "found")
    discard(opened, repeated)
    release_shuffles(spark)
    inside = _by_text(rest.where("kind = 2"), F.col("first"))
    out = cut(settled.unionByName(found).unionByName(inside).groupBy("text_hash", "bits").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("counts")).alias("counts")), "repeats")
    discard(settled, found, rest)
    release_shuffles(spark)
    return out


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.
    """
    raw = F.col("`text`").cast("string")
    texts = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.xxhash64(raw).alias("text_hash"),
                        F.xxhash64(F.lit(17), raw).bitwiseAND((1 << 24) - 1).alias("bits"), raw.cast("binary").alias("text"))
    known = texts.where("text is not null").select("text_hash", "bits", "text")
    copies = cut(known.groupBy("text_hash", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_hash", "bits"), "copies")
    runs = repeated_windows(known, length)
    fate = cut(runs.join(copies.withColumn("copy", F.lit(True)), ["text_hash", "bits"], "full_outer"), "fate")
    discard(runs, copies)
    return arrow_map(texts.join(fate, ["text_hash", "bits"], "left").select("doc_id", "text", "copy", "starts", "counts"), _kept(length),
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
