"""Benchmark decontamination: size-partitioned MinHash containment search, verified on shingles.

A document is contaminated by an item if it holds at least ``percent`` per cent of
the item's distinct ``k``-word shingles (A-Z lower-cased), wherever they stand.

*Search.*  An item with ``q`` shingles that a document must share ``need`` of is
sketched by its ``q - need + 1`` smallest shingle hashes.  A document that holds
``need`` shingles misses at most ``q - need``, so it holds one of the sketch: the
search loses nothing.  Sketches are partitioned by ``need`` into powers of two,
and a document is only held against partitions it is long enough to contain.  The
sketches go to the tasks in blocks of at most ``BLOCK_HASHES`` hashes, one pass over
the documents per block, so what is broadcast is bounded whatever the benchmark's
size.

*Verification.*  Only documents with a hit travel on, once each, together with the
items they may hold; the shingles themselves, as words, decide.

Defined results: null, empty and shorter items or texts (fewer words than ``k``)
match nothing.  Rows of the benchmark without item_id are ignored; rows that
repeat an item_id are each an item of that id, a pair is reported once with the
largest containment.  Documents without doc_id are searched too (id null).
Repeated documents are each reported, as one pair if they share their doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, columns_as, cut, text_slices
from ledgerlark.llm.textnum import fold, shingle_sets, word_list, words_of

BLOCK_HASHES = 1 << 20


def _need(q: int, percent: int) -> int:
    """The fewest shingles out of ``q`` that make ``percent`` per cent."""
    return max(1, -(-q * percent // 100))


def item_sketches(items: DataFrame, k: int, percent: int) -> DataFrame:
    """(item, need, hash): the smallest hashes of each item that any container shares one of."""
    schema = pa.schema([("item", pa.int64()), ("need", pa.int64()), ("hash", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, buf, offs in text_slices(batch.column(1)):
                w = words_of(buf, offs, lower=True)
                out = [np.empty((0, 3), np.int64)]
                for i, (s, n) in enumerate(zip(shingle_sets(w, k), np.diff(w.first), strict=True)):
                    if n >= k:
                        need = _need(len(s), percent)
                        h = s[: len(s) - need + 1].view(np.int64)
                        out.append(np.stack([np.full(len(h), ids[lo + i].as_py()), np.full(len(h), need), h], axis=1))
                rows = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(3)], schema=schema)

    return arrow_map(items, run, "item long, need long, hash long")


class _Partition:
    """The sketches of one size class: sorted hashes, with a bitmap that settles most misses."""

    def __init__(self, item: np.ndarray, need: np.ndarray, h: np.ndarray) -> None:
        order = np.argsort(h)
        self.hash, self.item, self.need = h[order], item[order], need[order]
        self.least = int(need.min())
        self.shift = np.uint64(64 - min(24, max(12, len(h).bit_length() + 5)))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.hash >> self.shift] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into grams, index into the sketch) of every match."""
        at = np.flatnonzero(self.seen[grams >> self.shift])
        lo, hi = (np.searchsorted(self.hash, grams[at], side) for side in ("left", "right"))
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        return np.repeat(at, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _search(k: int, shared):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("items", pa.list_(pa.int64()))])

    def run(batches):
        parts = shared.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, buf, offs in text_slices(texts):
                w = words_of(buf, offs, lower=True)
                grams = fold(w.hashes, k)
                # A shingle belongs to the row it starts in, if it ends there too.
                row = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))[: len(grams)]
                inside = np.arange(len(grams)) + k <= w.first[1:][row]
                length = np.diff(w.first) - k + 1
                pairs = [np.empty((0, 2), np.int64)]
                for p in parts:
                    use = np.flatnonzero(inside & (length[row] >= p.least))
                    g, s = p.find(grams[use])
                    r = row[use[g]]
                    fits = length[r] >= p.need[s]
                    pairs.append(np.stack([r[fits], p.item[s[fits]]], axis=1))
                found = np.unique(np.concatenate(pairs), axis=0)
                if len(found):
                    at = np.unique(found[:, 0])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(lo + at)), texts.take(pa.array(lo + at)),
                         pa.array([found[found[:, 0] == r, 1] for r in at], pa.list_(pa.int64()))], schema=schema)

    return run


def _confirm(k: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int64()), ("n_common", pa.int64()), ("n_item", pa.int64())])

    def grams(words: list[bytes]) -> set:
        return set(zip(*(words[i:] for i in range(k)), strict=False))

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, items in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items")), strict=True):
                have = grams(word_list(text, lower=True))
                for it in items:
                    want = grams(word_list(it["item_text"], lower=True))
                    both = len(want & have)
                    if want and both >= _need(len(want), percent):
                        out.append((doc, it["item"], both, len(want)))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], schema=schema)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Pairs (doc_id, item_id, n_common, n_item): documents that hold a benchmark item."""
    spark = docs.sparkSession
    docs = columns_as(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    # Items get a number of their own: item_id may repeat.
    items = cut(columns_as(benchmark, "item_id", "text").where("item_id is not null and text is not null")
                .select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")), "items")
    sketches = cut(item_sketches(items.select("item", "item_text"), k, percent), "sketches")
    total = sketches.count()
    blocks = max(1, -(-total * 5 // (4 * BLOCK_HASHES)))   # a fifth spare, for blocks are dealt by hash
    hits = None
    for b in range(blocks):
        rows = sketches.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow()
        item, need, h = (rows.column(c).to_numpy() for c in ("item", "need", "hash"))
        size_class = np.floor(np.log2(np.maximum(need, 1))).astype(int)
        parts = [_Partition(item[m], need[m], h[m].view(np.uint64)) for c in np.unique(size_class) for m in [size_class == c]]
        found = cut(arrow_map(docs, _search(k, spark.sparkContext.broadcast(parts)), "doc_id long, text string, items array<long>")
                    .withColumn("row", F.monotonically_increasing_id()).withColumn("block", F.lit(b)), "hits")
        hits = found if hits is None else hits.unionByName(found)
    wanted = (hits.select("block", "row", F.explode("items").alias("item")).join(items, "item")
              .groupBy("block", "row").agg(F.collect_list(F.struct("item", "item_text")).alias("items")))
    pairs = arrow_map(hits.drop("items").join(wanted, ["block", "row"]).select("doc_id", "text", "items"),
                      _confirm(k, percent), "doc_id long, item long, n_common long, n_item long")
    best = F.max_by(F.struct("n_common", "n_item"), F.struct(F.col("n_common") / F.col("n_item"), "n_common")).alias("best")
    return (pairs.join(items.select("item", "item_id"), "item").groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.n_common", "best.n_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept.

    A document without doc_id cannot be named by the search's result; it stays.
    """
    bad = cut(contaminated(docs, benchmark, k, percent).where("doc_id is not null").select(F.col("doc_id").alias("id")).distinct(), "leaks")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return packed.join(bad, "id", "left_anti").select("row.*")
