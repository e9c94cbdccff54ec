"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets one 64-bit hash string per tree (signs of random projections;
for the largest inner product the vectors are first lifted to one length by an
extra component).  A tree is the sorted array of its strings: a query's place in it
is where its longest-prefix matches lie, and walking away from there shortens the
common prefix.

*Index.*  All (tree, string) entries are range-sorted by Spark and numbered; runs of
``BLOCK`` entries are the blocks.  Blocks have equal size whatever the strings, so
no bucket can be hot.  Equal strings stand in an order that differs from tree to tree,
so the trees offer different parts of a run longer than a block.  A query entry is sorted in among them and sent to its own
block and the two beside it.

*Descent and ascent.*  A first pass counts, per query, how many entries match at
each prefix length, over all trees.  The depth of a query is the longest prefix at
which all trees together give ``CANDIDATES`` entries: the ascent is in step in all
trees, and its length differs from query to query.  A second pass scores the
matches of that length or more (all of them within the three blocks) in double
precision and keeps the best per tree and block.

*Rest.*  A tree has read a query's prefix run as a whole if the entries just outside
its three blocks share less of the string.  A point with at least the score of the
query's last result lies within a known angle, hence has a known least chance of
standing in such a run; from that follows the chance that all trees missed it.
Queries for which it is above ``MISS`` (too large a table for three blocks, a run of
like strings longer than that, neighbours that do not stand out) are compared with
every point, in tiles of ``PART`` queries and ``SLICE`` points.

Equal vectors are one entry with their smallest ids, as many as a result can hold,
so a vector that a third of all rows share costs one entry (the ids are limited per
task before they are shuffled).

The descent takes at most ``trees * 3 * BLOCK`` scores per query, the rest one per
point: linear in the rows where neighbours stand out, queries times points where they
do not, since there no hash tells them apart.  The README has figures.

Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, neither do null ids and vectors of another length than most have.  Of rows that
repeat an id the smallest vector counts.  Ties go to the smaller id.  Fewer
candidates than ``k``: all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, cut, release_shuffles

TREES, BLOCK, CANDIDATES = 16, 4096, 100_000
BITS = 64
#: Greatest chance of missing a neighbour with which a query is left to the forest alone.
MISS = 0.01
#: Queries and points of a tile, and the least number of slices of the points.
PART, SLICE, SLICES = 65_536, 32_768, 32


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the vectors that take part, one per id, components as double."""
    v = F.col("v")
    out = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    good = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return out.where(F.col("id").isNotNull() & v.isNotNull()).where(good).groupBy("id").agg(F.min("v").alias("v"))


def _entries(trees: int, dim: int, longest: float, seed: int, lift: bool):
    """Rows (rep, v) to one (tree, string) entry per tree; strings order like signed longs."""
    schema = pa.schema([("tree", pa.int32()), ("string", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        planes = np.random.default_rng(seed).standard_normal((dim + 1, trees * BITS))
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = _matrix(part.column(1), dim)
                extra = np.sqrt(np.maximum(longest - (x**2).sum(axis=1), 0)) if lift else np.zeros(len(x))
                signs = (x @ planes[:dim] + extra[:, None] * planes[dim]) > 0
                s = np.packbits(signs, axis=1).view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(trees, dtype=np.int32), len(x))), pa.array(s.ravel().view(np.int64)),
                     pa.array(np.repeat(part.column(0).to_numpy(), trees))], schema=schema)

    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _numbered(entries: DataFrame) -> DataFrame:
    """The entries in order of (tree, string), dealt to blocks of BLOCK; equal strings in another order in each tree."""
    placed = cut(entries.orderBy("tree", "string", F.xxhash64("tree", "rep"), "is_query", "rep").withColumn("place", F.monotonically_increasing_id()), "forest-order")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    # One row per sort partition: as many as the shuffle has, whatever the data.
    rank = F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33)
    return placed.withColumn("part", part).join(F.broadcast(before), "part").select(
        "tree", "string", "is_query", "rep", F.floor(rank / BLOCK).cast("long").alias("block"))


def _groups(batches):
    """Consecutive rows of one (tree, block), gathered from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, block = (batch.column(c).to_numpy() for c in ("tree", "block"))
        edge = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        bounds = [0, *edge.tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if held and any(held[-1].column(c)[0] != part.column(c)[0] for c in ("tree", "block")):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that every string of ``a`` shares with every one of ``b`` (uint64)."""
    x = a[:, None] ^ b[None, :]
    high = (x >> np.uint64(32)).astype(np.float64)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    top = np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])   # bit length of x
    return (BITS - top).astype(np.int8)


def _level_counts():
    """Per query and prefix length, how many points of a block match to just that length."""
    schema = pa.schema([("rep", pa.int64()), ("level", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for g in _groups(batches):
            is_query, rep, s = (g.column(c).to_numpy() for c in ("is_query", "rep", "string"))
            s = s.view(np.uint64)
            points, queries = s[~is_query], np.flatnonzero(is_query)
            for lo in range(0, len(queries), 256):
                q = queries[lo : lo + 256]
                if len(points):
                    level = common_prefix(s[q], points).astype(np.int64)
                    flat = np.bincount((np.arange(len(q))[:, None] * (BITS + 1) + level).ravel(), minlength=len(q) * (BITS + 1)).reshape(len(q), -1)
                    r, c = np.nonzero(flat)
                    yield pa.RecordBatch.from_arrays([pa.array(rep[q][r]), pa.array(c.astype(np.int32)), pa.array(flat[r, c].astype(np.int64))], schema=schema)

    return run


def _best(dim: int, keep: int):
    """The ``keep`` best points of a block for each query among those deep enough."""
    schema = pa.schema([("rep", pa.int64()), ("found", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for g in _groups(batches):
            g = g.combine_chunks()
            is_query, rep, s, depth = (g.column(c).to_numpy() for c in ("is_query", "rep", "string", "depth"))
            s, x = s.view(np.uint64), _matrix(g.column("v").combine_chunks(), dim)
            pts, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
            pts = pts[np.argsort(rep[pts], kind="stable")]
            p = np.ascontiguousarray(x[pts])
            step = max(1, min(256, (4 << 20) // max(1, len(pts))))
            for lo in range(0, len(queries) if len(pts) else 0, step):
                q = queries[lo : lo + step]
                score = x[q] @ p.T
                if depth[q].any():
                    score[common_prefix(s[q], s[pts]) < depth[q][:, None]] = -np.inf
                if len(pts) > keep:
                    # The keep-th largest value, and all that tie with it: ids decide later.
                    least = -np.partition(-score, keep - 1, axis=1)[:, keep - 1]
                else:
                    least = np.full(len(q), -np.inf)
                r, c = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                # Of ties the smaller ids, which stand first.
                better = score[r, c] > least[r]
                tie = np.flatnonzero(~better)
                room = keep - np.bincount(r[better], minlength=len(q))
                first = np.searchsorted(r[tie], np.arange(len(q)))
                use = better.copy()
                use[tie[np.arange(len(tie)) - first[r[tie]] < room[r[tie]]]] = True
                r, c = r[use], c[use]
                yield pa.RecordBatch.from_arrays([pa.array(rep[q][r]), pa.array(rep[pts][c]), pa.array(score[r, c])], schema=schema)

    return run


def _by_vector(rows: DataFrame, most: int) -> DataFrame:
    """Distinct vectors (rep, v, ids): the smallest id, and the ``most`` smallest."""
    order = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)   # limited before the shuffle
    return few.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))


def _whole(placed: DataFrame) -> DataFrame:
    """(rep, whole) per query and tree: the shortest prefix whose entries all stand in the three blocks; BITS + 1: none does."""
    edges = placed.groupBy("tree", "block").agg(F.min("string").alias("low"), F.max("string").alias("high"))
    before = edges.select("tree", (F.col("block") + 2).alias("block"), "high")
    after = edges.select("tree", (F.col("block") - 2).alias("block"), "low")

    def shared(other):
        x = F.col("string").bitwiseXOR(F.col(other))
        return F.when(F.col(other).isNull(), -1).when(x == 0, BITS).otherwise(BITS - F.length(F.bin(x)))

    return (placed.where("is_query").join(before, ["tree", "block"], "left").join(after, ["tree", "block"], "left")
            .select("rep", (F.greatest(shared("high"), shared("low")) + 1).alias("whole")))


def _missed(whole: DataFrame, depths: DataFrame, last: DataFrame, asked: DataFrame, longest: float) -> DataFrame:
    """(rep, miss): the chance at most that every tree misses a point with the score of the query's last result."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)) * float(np.sqrt(longest))
    cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.coalesce(F.col("score") / norm, F.lit(-1.0))))
    agree = 1 - F.acos(cosine) / F.pi()   # the chance that one bit is the same
    # One depth for all trees, the greatest: a tree that parts the query from its neighbours has a short run, so a depth
    # of each tree's own would trust just those trees.
    deepest = whole.groupBy("rep").agg(F.max("whole").alias("whole"), F.count(F.lit(1)).alias("trees"))
    chance = F.when(F.col("whole") <= BITS, F.pow(agree, F.greatest("whole", "depth"))).otherwise(0.0)
    return (asked.join(last, "rep", "left").join(depths, "rep").join(deepest, "rep")
            .select("rep", F.pow(1 - chance, "trees").alias("miss")))


def _all_pairs(asked: DataFrame, n_asked: int, points: DataFrame, n_points: int) -> DataFrame:
    """Every query beside every point, in tiles named like blocks."""
    parts, slices = -(-n_asked // PART), max(SLICES, -(-n_points // SLICE))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def one(n):
        return F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int")

    rest = ["rep", F.lit(0).cast("long").alias("string"), F.lit(0).alias("depth"), "v"]
    return (asked.select(one(parts).alias("tree"), every(slices).alias("block"), F.lit(True).alias("is_query"), *rest)
            .unionByName(points.select(every(parts).alias("tree"), one(slices).alias("block"), F.lit(False).alias("is_query"), *rest)))


def _nearest(scored: DataFrame, most: int) -> DataFrame:
    """The ``most`` best points of each query: rep, found, score, nth."""
    best = scored.groupBy("rep", "found").agg(F.max("score").alias("score"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "found")
    return best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def forest_search(vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, candidates: int = CANDIDATES, seed: int = 11) -> DataFrame:
    """The ``k`` nearest rows found for each query: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` as from ``usable``; a row whose id is the query's is
    no candidate.  ``candidates``: entries, over all trees, that end the ascent.
    """
    spark = vectors.sparkSession
    vectors, queries = cut(vectors, "vectors"), cut(queries, "query-vectors")
    lengths = vectors.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    dim, longest = (most.dim, most.longest) if most else (1, 0.0)
    points = cut(_by_vector(vectors.where(F.size("v") == dim), k + 1), "points")
    asked = cut(queries.where(F.size("v") == dim).groupBy("v").agg(F.min("id").alias("rep")), "asked")

    shape = "tree int, string long, rep long"
    entries = (arrow_map(points.select("rep", "v"), _entries(trees, dim, longest, seed, True), shape).withColumn("is_query", F.lit(False))
               .unionByName(arrow_map(asked.select("rep", "v"), _entries(trees, dim, longest, seed, False), shape).withColumn("is_query", F.lit(True))))
    placed = cut(_numbered(entries), "forest")
    around = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    dealt = placed.where("not is_query").select("tree", "block", "is_query", "rep", "string").unionByName(
        placed.where("is_query").select("tree", around.alias("block"), "is_query", "rep", "string"))

    counted = arrow_map(dealt.repartition("tree", "block").sortWithinPartitions("tree", "block"), _level_counts(), "rep long, level int, n long")
    levels = counted.groupBy("rep", "level").agg(F.sum("n").alias("n"))
    deeper = Window.partitionBy("rep").orderBy(F.desc("level"))
    reached = levels.select("rep", "level", F.sum("n").over(deeper).alias("total"))
    depths = cut(reached.groupBy("rep").agg(F.max(F.when(F.col("total") >= candidates, F.col("level"))).alias("depth"))
                 .select("rep", F.coalesce("depth", F.lit(0)).alias("depth")), "depths")
    release_shuffles(spark)

    with_vector = (dealt.where("not is_query").withColumn("depth", F.lit(0)).join(points.select("rep", "v"), "rep")
                   .unionByName(dealt.where("is_query").join(depths, "rep").join(asked, "rep")))
    def score(tiles):
        return arrow_map(tiles.repartition("tree", "block").sortWithinPartitions("tree", "block"), _best(dim, k + 1), "rep long, found long, score double")

    # One more distinct vector than asked for, since one may be only the query itself.  Matrix products may differ
    # in the last bit between blocks, so the scores of what is left are summed anew, component by component.
    best = cut(_nearest(score(with_vector.select("tree", "block", "is_query", "rep", "string", "depth", "v")), k + 1), "best")
    last = best.where(F.col("nth") == k + 1).select("rep", "score")
    unsure = cut(_missed(_whole(placed), depths, last, asked, longest).where(F.col("miss") > MISS).select("rep").join(asked, "rep"), "unsure")
    release_shuffles(spark)
    if n_unsure := unsure.count():
        rest = _nearest(score(_all_pairs(unsure, n_unsure, points, points.count())), k + 1)
        best = best.join(unsure.select("rep"), "rep", "left_anti").unionByName(cut(rest, "best-of-all"))
    best = best.select("rep", "found")
    product = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    best = (best.join(asked.select("rep", F.col("v").alias("q")), "rep")
            .join(points.select(F.col("rep").alias("found"), "v", "ids"), "found").select("rep", "ids", product.alias("score")))
    own = queries.select(F.col("id").alias("query_id"), "v").join(asked, "v").select("query_id", "rep")
    answers = (best.join(own, "rep")
               .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
