"""Near-duplicate documents: universal hash minima, banding, verification, star contraction.

1. Each text becomes its set of distinct word shingles.  Rows with one set share
   a digest and are represented by their smallest ``doc_id``, so a group of exact
   copies costs one map-side minimum and never meets in one task.
2. A representative gets ``bands * rows`` minima of universal hash functions.  Each
   band of minima is a bucket; a pair at similarity ``t`` misses every bucket with
   probability ``(1 - t**rows)**bands`` (5e-7 for the defaults at 0.8).
3. In each bucket the smallest member is the pivot and every other member is
   compared with it: as many comparisons as members.  Signatures (one byte of each
   of ``SIGNATURE`` minima) discard pairs far below the threshold; of the others a
   parity sketch gives a lower bound of the sets' difference, which discards
   without error; the full shingle sets decide.
4. Connected components by alternating large-star and small-star rounds.
5. Buckets that still hold several components are compared member by member, in
   blocks, across components only, so no link is lost to the choice of pivot.  Only
   pairs that pass signature and sketch leave a block.

Defined results: a text that is null, empty or has no word has an empty set and is
linked with nothing.  Fewer words than a shingle: the whole sequence is the one
shingle.  Rows that share a ``doc_id`` count as one document with several texts.
Rows whose ``doc_id`` is null take no part (component null, kept).  Extra columns
of the input are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, columns_as, cut, release_shuffles, text_slices
from ledgerlark.llm.textnum import mix, shingle_sets, word_list, words_of

BANDS, ROWS = 48, 6
#: Members of one side of a block in the comparison across components.
BLOCK = 256
#: Minima whose low bytes make the signature.
SIGNATURE = 128
#: A signature estimate this far below the threshold (7 standard errors at 0.8) rules a pair out.
SLACK = 0.25


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(77))
    a = rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 2**32, n, dtype=np.uint32)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each universal hash function the smallest value over the set."""
    x, best = (shingles >> np.uint64(32)).astype(np.uint32), None
    for lo in range(0, len(x), 512):
        v = x[lo : lo + 512, None] * a
        v += b
        m = v.min(axis=0)
        best = m if best is None else np.minimum(best, m)
    return best


def parity_sketch(shingles: np.ndarray) -> bytes:
    """For each of ``L`` slots (a power of two, 2 to 4 times the set) whether it got an odd number of shingles."""
    size = 1 << max(6, (2 * len(shingles) - 1).bit_length())
    slots = (shingles & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch (bytes along the last axis) over fewer slots: parities of merged slots add up."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def least_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the size of the symmetric difference: slots whose parity differs."""
    size = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum(axis=-1, dtype=np.int64)


def most_difference(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """How large the difference of sets of these sizes may be at ``percent`` similarity."""
    return (100 - percent) * (n + m) // (100 + percent)


def _profiles(k: int, bands: int, rows: int):
    """Arrow function: (doc_id, text) -> set size, set digest, band keys, signature, sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("band_keys", pa.list_(pa.int64())), ("signature", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(bands * rows)
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            ids = batch.column(0)
            for lo, buf, offs in text_slices(batch.column(1)):
                sizes, digests, keys, sigs, sketches = [], [], [], [], []
                for s in shingle_sets(words_of(buf, offs, lower=True), k):
                    sizes.append(len(s))
                    if not len(s):
                        digests.append(None), keys.append(None), sigs.append(None), sketches.append(None)
                        continue
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    m = minima(s, a, b)
                    sigs.append((m[:SIGNATURE] & np.uint32(255)).astype(np.uint8).tobytes())
                    sketches.append(parity_sketch(s))
                    h = salt.copy()
                    for c in m.reshape(bands, rows).T.astype(np.uint64):
                        h = mix(h + c)
                    keys.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(sizes)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), pa.array(sketches, pa.binary())], schema=schema)

    return run


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity from one-byte signatures (last axis); chance agreement is one in 256."""
    return ((left == right).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _signature_test(pairs: DataFrame, profiles: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures and sketches allow the similarity, so the texts are worth reading."""
    def side(c: str) -> DataFrame:
        return profiles.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n_shingles", "signature", "sketch")])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", *[f"{x}_{c}" for c in ("a", "b") for x in ("n_shingles", "signature", "sketch")])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            (n, left, s), (m, right, t) = [[batch.column(c + j) for j in range(3)] for c in (2, 5)]
            sigs = [np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, width) for x in (left, right)]
            close = np.flatnonzero(estimates(*sigs) >= percent / 100 - SLACK)
            most = most_difference(n.to_numpy(), m.to_numpy(), percent)
            keep = pa.array([i for i in close.tolist()
                             if least_difference(np.frombuffer(s[i].as_py(), np.uint8), np.frombuffer(t[i].as_py(), np.uint8)) <= most[i]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], schema=schema)

    return arrow_map(joined, run, "a long, b long")


def _shingles(text: str | None, k: int) -> set:
    w = word_list(text, lower=True)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(k)), strict=False))


def verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets satisfy ``100 * |intersection| >= percent * |union|``."""
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last, last_set = None, set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part, keep = batch.slice(lo, 512), []
                for b, ta, tb in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if (b, tb) != last:   # rows arrive sorted by the pivot
                        last, last_set = (b, tb), _shingles(tb, k)
                    s = _shingles(ta, k)
                    both = len(s & last_set)
                    keep.append(both > 0 and 100 * both >= percent * (len(s) + len(last_set) - both))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], schema=schema)

    return arrow_map(joined, run, "a long, b long").distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


# Aggregates are written before they are joined: a join of two plain exchanges lets AQE
# split the node that a large group has as its centre, or its bucket.


def _large_star(edges: DataFrame) -> DataFrame:
    sym = _both_ways(edges)
    low = cut(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return sym.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = cut(down.groupBy("u").agg(F.min("v").alias("m")), "minima")
    links = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return links.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge: the component is its smallest node.

    Alternates large-star and small-star until the edges are stars around the
    minima and no longer change; each round is written to the shared folder.
    """
    state, mark = edges.select("a", "b"), None
    while True:
        state = cut(_small_star(_large_star(state)), "stars")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (now[0], now[1]) == mark:
            break
        mark = (now[0], now[1])
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _rest_candidates(members: DataFrame, labels: DataFrame, profiles: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs across components inside one bucket, compared by signature and sketch in blocks."""
    named = members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = cut(named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
                .where("lo <> hi and n > 2").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    dealt = (named.join(mixed, "key").join(profiles, "node")
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "component", "n_shingles", "signature", "sketch"))
    parts = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        own, node, comp, size = (rows.column(c).to_numpy() for c in ("own", "node", "component", "n_shingles"))
        sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, width)
        sketch = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
        slots = np.array([len(x) for x in sketch])
        of_size = {c: (np.flatnonzero(slots == c), np.stack([sketch[r] for r in np.flatnonzero(slots == c)])) for c in np.unique(slots)}
        at = np.empty(len(slots), np.int64)   # row of each member in the matrix of its sketch size
        for r, _ in of_size.values():
            at[r] = np.arange(len(r))
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        out = [np.empty((0, 2), np.int64)]
        for x in left:
            y = right[(comp[right] != comp[x]) & ((node[right] > node[x]) if i == j else True)]
            if len(y):
                y = y[estimates(sig[y], sig[x]) >= percent / 100 - SLACK]
            for c in np.unique(slots[y]):
                z = y[slots[y] == c]
                z = z[least_difference(of_size[c][1][at[z]], sketch[x]) <= most_difference(size[z], size[x], percent)]
                out.append(np.stack([np.maximum(node[z], node[x]), np.minimum(node[z], node[x])], axis=1))
        e = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], schema=schema)

    def run(batches):
        held: list[pa.RecordBatch] = []   # rows of the block pair that is still open
        for batch in batches:
            if not batch.num_rows:
                continue
            key, i, j = (batch.column(c).to_numpy() for c in (0, 1, 2))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *edge.tolist(), batch.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if held and [held[-1].column(c)[0] for c in (0, 1, 2)] != [part.column(c)[0] for c in (0, 1, 2)]:
                    yield pairs_of(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield pairs_of(pa.Table.from_batches(held))

    return arrow_map(parts, run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links of at least
    ``percent`` per cent Jaccard similarity of ``k``-word shingle sets.
    """
    spark = docs.sparkSession
    docs = columns_as(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    width = min(SIGNATURE, bands * rows)
    profile = cut(arrow_map(docs, _profiles(k, bands, rows),
                            "doc_id long, n_shingles long, digest binary, band_keys array<long>, signature binary, sketch binary"), "profiles")
    known = docs.where("doc_id is not null")
    linkable = profile.where("doc_id is not null and digest is not null")
    reps = cut(linkable.groupBy("digest").agg(F.min("doc_id").alias("node")), "representatives")
    first = linkable.join(reps, "digest").where("doc_id = node").select("node", "n_shingles", "band_keys", "signature", "sketch")
    rep_rows = cut(first, "reps")
    # Rows of one doc_id with several texts meet here as one node with several sets.
    several = (linkable.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select(F.col("doc_id").alias("a")))
    same_id = (linkable.select("doc_id", "digest").join(reps, "digest").where("doc_id <> node")
               .select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct().join(several, "a", "left_semi"))

    profiles = rep_rows.select("node", "n_shingles", "signature", "sketch")
    banded = rep_rows.select("node", F.explode("band_keys").alias("key"))
    pivots = cut(banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
                 .where("pivot <> top").select("key", "pivot"), "pivots")
    members = cut(banded.join(pivots, "key").select("key", "node", "pivot").distinct(), "members")
    release_shuffles(spark)
    star = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    tried = cut(_signature_test(star, profiles, width, percent).distinct(), "star")
    links = cut(verify(tried, known, k, percent).union(same_id), "links")
    release_shuffles(spark)
    labels = cut(connected_components(links), "labels")

    rest = cut(_rest_candidates(members.select("key", "node"), labels, profiles, width, percent).join(tried, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = cut(verify(rest, known, k, percent), "more")
        release_shuffles(spark)
        stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = cut(connected_components(stars.union(more)), "labels")
    release_shuffles(spark)

    return (profile.select("doc_id", "n_shingles", "digest").join(reps, "digest", "left").join(labels, "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each group left (the smallest doc_id); all columns kept.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    found = (near_duplicates(docs, k, percent).where("kept and doc_id is not null")
             .select(F.col("doc_id").alias("id")).distinct())
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"))
    alone = Window.partitionBy("id").orderBy("text_hash")
    one = (packed.where("id is not null").withColumn("nth", F.row_number().over(alone))
           .where("nth = 1").join(found, "id", "left_semi"))
    return one.select("row.*").unionByName(packed.where("id is null").select("row.*"))
