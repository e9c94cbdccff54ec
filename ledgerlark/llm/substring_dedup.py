"""Repeated spans of words: token k-mers as edges, paths compacted by joins, sources verified.

A window of ``k`` consecutive words is an edge between its two ``k-1``-word nodes.
The steps, each a Spark job over the whole corpus:

1. *Seeds.*  The smallest of a window's ``seed``-word hashes is its seed; equal
   windows have equal seeds, so a window whose seed occurs once is not repeated.
   About one position in seven is a seed, which keeps the first shuffle small.
2. *Edges.*  Windows with a repeated seed are grouped by hash with their first
   source coordinate (document rank and word position packed in one long).
3. *Paths.*  A join hands every later occurrence of an edge its source coordinate.
   Consecutive edges whose coordinates advance in step form a path without a
   branch; each path collapses to one row: start, length, start of its source.
4. *Verification.*  SHA-256 of the words at both coordinates must agree.  A path
   that fails (hash collision) falls back to grouping its windows by digest.
5. A word goes if a verified path covers it.

A document whose whole word sequence repeats an earlier one is settled by its
digest beforehand, so exact copies never enter the graph.  All grouping is on
single longs, pre-aggregated before each shuffle; the joins can be split by AQE.

Defined results: null or empty text has no words.  Rows without ``doc_id`` are
returned unchanged and are nobody's source.  Rows that repeat doc_id and text
are one document; rows of one doc_id with different texts are ordered by the hash
of the text.  Documents shorter than a window keep all words.  Extra columns are
ignored.  A document may have up to 2**26 words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, columns_as, cut, discard, release_shuffles, text_slices
from ledgerlark.llm.textnum import Words, fold, words_of

WINDOW, SEED = 20, 8
POSITION_BITS = 26


def window_seeds(w: Words, k: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, seed position, seed hash) of every window that lies in one row."""
    grams, n = fold(w.hashes, seed), len(w.hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, k - seed + 1):
        g = grams[j : n + j]
        less = g < best
        best[less] = g[less]
        at[less] = j
    row_end = np.repeat(w.first[1:], np.diff(w.first))[:n]
    start = np.flatnonzero(np.arange(n) + k <= row_end)
    return start, start + at[start], best[start]


def _seed_rows(k: int, seed: int):
    schema = pa.schema([("seed", pa.int64()), ("did", pa.int64()), ("sub", pa.int64()), ("n", pa.int32())])

    def run(batches):
        for batch in batches:
            for lo, buf, offs in text_slices(batch.column("text")):
                w = words_of(buf, offs)
                _, pos, h = window_seeds(w, k, seed)
                pos, i = np.unique(pos, return_index=True)
                h, row = h[i], np.searchsorted(w.first, pos, "right") - 1
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                take = pa.array(row[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), batch.column("did").take(take), batch.column("sub").take(take),
                     pa.array(np.diff(np.append(at, len(h))).astype(np.int32))], schema=schema)

    return run


def _whole_digests(k: int):
    schema = pa.schema([("did", pa.int64()), ("sub", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), batch.column("sub"),
                 pa.array([hashlib.sha256(b" ".join(w)).digest()[:16] if len(w) >= k else None for w in words], pa.binary())], schema=schema)

    return run


def _edge_rows(k: int, seed: int):
    """Rows (did, sub, rank, text, seeds) to the hash and packed coordinate of each candidate window."""
    schema = pa.schema([("edge", pa.int64()), ("at", pa.int64())])

    def run(batches):
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            lists = batch.column("seeds")
            for lo, buf, offs in text_slices(batch.column("text")):
                w = words_of(buf, offs)
                start, _, h = window_seeds(w, k, seed)
                row = np.searchsorted(w.first, start, "right") - 1
                bounds = np.searchsorted(row, np.arange(len(offs)))
                keep = np.zeros(len(start), bool)
                for r, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    if b > a:
                        keep[a:b] = np.isin(h[a:b].view(np.int64), lists[lo + r].values.to_numpy())
                start, row = start[keep], row[keep]
                pos = start - w.first[row]
                if len(pos) and int(pos.max()) >> POSITION_BITS:
                    raise ValueError(f"a document has more than 2**{POSITION_BITS} words")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fold(w.hashes, k)[start].view(np.int64)), pa.array((rank[lo + row] << POSITION_BITS) | pos)], schema=schema)

    return run


def _paths():
    """Sorted rows (at, source) to maximal runs where both advance by one: (at, source, n)."""
    schema = pa.schema([("at", pa.int64()), ("source", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held = None   # the run that is still open
        for batch in batches:
            at, src = batch.column("at").to_numpy(), batch.column("source").to_numpy()
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(src) != 1)
            heads = np.flatnonzero(new)
            runs = np.stack([at[heads], src[heads], np.diff(np.append(heads, len(at)))], axis=1)
            if held is not None:
                if held[0] + held[2] == runs[0, 0] and held[1] + held[2] == runs[0, 1]:
                    runs[0] = [held[0], held[1], held[2] + runs[0, 2]]
                else:
                    runs = np.concatenate([held[None], runs])
            held = runs[-1]
            yield pa.RecordBatch.from_arrays([pa.array(runs[:-1, c]) for c in range(3)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[c : c + 1]) for c in range(3)], schema=schema)

    return run


def _span_digests(k: int):
    """Rows (rank, text, starts, lengths) to the digest of the words of each requested path."""
    schema = pa.schema([("at", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                at, n, out = [], [], []
                part = batch.slice(lo, 256)
                for rank, text, asked in zip(*(part.column(c).to_pylist() for c in ("rank", "text", "asked")), strict=True):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    for a in asked:
                        p = a["at"] & ((1 << POSITION_BITS) - 1)
                        at.append(a["at"]), n.append(a["n"])
                        out.append(hashlib.sha256(b" ".join(words[p : p + a["n"] + k - 1])).digest())
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the document key (did, sub); ``sub`` is 0 unless a doc_id has several texts."""
    docs = columns_as(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    h = F.xxhash64("text")
    several = cut(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("did")).agg(F.min(h).alias("lo"), F.max(h).alias("hi"))
                  .where("lo <> hi").select("did", F.lit(True).alias("several")), "several")
    # Written first, so the planner sees its size: nearly always a broadcast of a few rows or none.
    return (docs.join(several, docs.doc_id == several.did, "left")
            .select("doc_id", "text", F.col("doc_id").alias("did"), F.when(F.col("several"), h).otherwise(F.lit(0)).alias("sub")))


def _ranked(keys: DataFrame) -> DataFrame:
    """Distinct (did, sub) with their dense rank in that order."""
    placed = cut(keys.orderBy("did", "sub").select("did", "sub", F.monotonically_increasing_id().alias("place")), "order")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    # One row per sort partition: as many as the shuffle has, whatever the data.
    return cut(placed.withColumn("part", part).join(F.broadcast(before), "part")
               .select("did", "sub", (F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33)).alias("rank")), "ranks")


def _path_table(dup: DataFrame) -> DataFrame:
    doc = F.shiftright("at", POSITION_BITS)
    return arrow_map(dup.select("at", "source").repartition(doc).sortWithinPartitions("at"), _paths(), "at long, source long, n long")


def _digest_table(asked: DataFrame, ranked_text: DataFrame, k: int) -> DataFrame:
    """(at, n, digest) of the distinct requests ``asked`` (at, n)."""
    per_doc = (asked.distinct().groupBy(F.shiftright("at", POSITION_BITS).alias("rank"))
               .agg(F.collect_list(F.struct("at", "n")).alias("asked")))
    return arrow_map(ranked_text.join(per_doc, "rank").select("rank", "text", "asked"), _span_digests(k), "at long, n long, digest binary")


def repeated_spans(docs: DataFrame, k: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paths, ranks, copies): verified repeats as packed coordinates, the ranks behind
    them, and documents that repeat an earlier one as a whole (did, sub)."""
    return _repeated(_keyed(docs), k, seed)


def _repeated(keyed: DataFrame, k: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    spark = keyed.sparkSession
    known = keyed.where("did is not null").select("did", "sub", "text")
    whole = cut(arrow_map(known, _whole_digests(k), "did long, sub long, digest binary").where("digest is not null").distinct(), "whole")
    first = cut(whole.groupBy("digest").agg(F.min("did").alias("first_did"), F.count(F.lit(1)).alias("n")).where("n > 1"), "first")
    later = whole.join(first, "digest")
    # Several texts of one doc_id cannot be equal, so the smallest did is one document.
    copies = cut(later.where("did > first_did").select("did", "sub"), "copies")

    seeds = cut(arrow_map(known, _seed_rows(k, seed), "seed long, did long, sub long, n int"), "seeds")
    often = cut(seeds.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed"), "often")
    release_shuffles(spark)
    hits = cut(seeds.join(often, "seed").select("did", "sub", "seed").join(copies, ["did", "sub"], "left_anti")
               .groupBy("did", "sub").agg(F.collect_list("seed").alias("seeds")), "hits")
    ranks = _ranked(hits.select("did", "sub"))
    discard(whole, seeds, often)
    release_shuffles(spark)

    # One text of each document: rows that repeat both doc_id and text are one.
    wanted = hits.join(ranks, ["did", "sub"])
    edges = cut(arrow_map(known.join(wanted, ["did", "sub"]).select("rank", "text", "seeds"), _edge_rows(k, seed), "edge long, at long"), "edges")
    release_shuffles(spark)
    # Aggregates are written before the join: a join of two plain exchanges lets AQE split what occurs everywhere.
    source = cut(edges.groupBy("edge").agg(F.min("at").alias("source"), F.count(F.lit(1)).alias("n")).where("n > 1").select("edge", "source"), "sources")
    release_shuffles(spark)
    paths = cut(_path_table(edges.join(source, "edge").where("at > source")), "paths")
    discard(hits, source)
    release_shuffles(spark)

    text = known.join(ranks, ["did", "sub"]).select("rank", "text")
    asked = paths.select("at", "n").union(paths.select(F.col("source").alias("at"), "n"))
    digests = cut(_digest_table(asked, text, k), "digests")
    here, there = digests.distinct(), digests.select(F.col("at").alias("source"), "n", F.col("digest").alias("theirs")).distinct()
    checked = cut(paths.join(here, ["at", "n"]).join(there, ["source", "n"]).select("at", "source", "n", (F.col("digest") == F.col("theirs")).alias("same")), "checked")
    good = checked.where("same").select("at", "source", "n")
    bad = checked.where("not same")
    if not bad.isEmpty():
        good = good.unionByName(cut(_by_digest(bad, edges, text, k), "by-digest"))
    discard(paths, digests, edges)
    release_shuffles(spark)
    return good, ranks, copies


def _by_digest(bad: DataFrame, edges: DataFrame, text: DataFrame, k: int) -> DataFrame:
    """Windows whose hash stands for several word sequences, grouped by digest instead."""
    at = bad.select(F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at"))
    clash = edges.join(at, "at", "left_semi").select("edge").distinct()
    spots = cut(edges.join(clash, "edge", "left_semi"), "clash")
    digests = _digest_table(spots.select("at", F.lit(1).cast("long").alias("n")), text, k).distinct()
    named = cut(spots.join(digests, "at"), "named")
    first = named.groupBy("edge", "digest").agg(F.min("at").alias("source"))
    return _path_table(named.join(first, ["edge", "digest"]).where("at > source"))


def _kept(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                total, gone, kept = [], [], []
                for text, copy, spans in zip(*(part.column(c).to_pylist() for c in ("text", "copy", "spans")), strict=True):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    total.append(len(words))
                    if copy:
                        words = []
                    elif spans:
                        keep = np.ones(len(words), bool)
                        for s in spans:
                            p = s["at"] & ((1 << POSITION_BITS) - 1)
                            keep[p : p + s["n"] + k - 1] = False
                        words = [words[i] for i in np.flatnonzero(keep)]
                    gone.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], schema=schema)

    return run


def drop_repeated_spans(docs: DataFrame, k: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_text (words joined by one space).

    A word goes if a ``k``-word window that covers it also starts earlier: in a
    document of smaller doc_id, or earlier in the same document.
    """
    keyed = _keyed(docs)
    paths, ranks, copies = _repeated(keyed, k, seed)
    spans = (paths.groupBy(F.shiftright("at", POSITION_BITS).alias("rank")).agg(F.collect_list(F.struct("at", "n")).alias("spans"))
             .join(ranks, "rank").select("did", "sub", "spans", F.lit(False).alias("copy")))
    fate = cut(spans.unionByName(copies.distinct().withColumn("copy", F.lit(True)).withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))), "fate")
    return arrow_map(keyed.join(fate, ["did", "sub"], "left").select("doc_id", "text", "copy", "spans"), _kept(k),
                     "doc_id long, n_words long, n_removed long, kept_text string")
