"""Centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors become integers ``floor(1024 * x)``; all results are exact.

1. *Order.*  Each vector gets its place on a Hilbert curve through the cube of all
   vectors (``CURVE_BITS`` a dimension).  Spark sorts by that key; runs of up to ``BLOCK``
   vectors become one row of the block table: the zone map (least and greatest value of
   each dimension), the sum of the vectors, and the vectors themselves.
2. *Candidates.*  A centroid is no candidate of a block if another is nearer to every
   point of the block's box: the greatest difference of the two squared distances over a box
   is a sum of one bound per dimension.
3. *Comparison.*  A block with one candidate adds its stored sum and never opens
   its vectors; in the others each vector is compared with the candidates only.
4. *Update.*  Tasks add vectors up by centroid; the driver receives one sum per
   centroid and dimension, divides exactly and starts the next round.

Blocks are cut from sorted partitions, whose ranges are sampled over (key, place in the
input), so copies of one vector spread over as many tasks as any other rows.

Defined results: vectors that are null, of another length than ``dim``, or hold null
or non-finite components are left out.  Start centroids are chosen among rows with an
id, by hash and then vector; repeated rows count as often as they stand there, though a start is one row.  Fewer
rows than centroids: as many centroids as rows; none: no rows.  Rows without id are
assigned like any other.  ``floor(1024 * x)`` is held within +-2**62; a distance of 2**63 or more
is given as 2**63 - 1.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, cut, discard
from ledgerlark.llm.whitening import finite_vectors

SCALE = 1024
BLOCK = 256
CURVE_BITS = 4
#: Components up to this size have squared distances that a double holds exactly.
SAFE = 1 << 22
_EDGE = float(2**62)
_MOST = 2**63 - 1


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    c = column.flatten().to_numpy().reshape(-1, dim)
    return np.floor(np.clip(c * SCALE, -_EDGE, _EDGE)).astype(np.int64)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (values below ``2**bits``), as bytes that sort like numbers.

    Works on all rows at once: the axes are brought to transposed form by exchange and
    inversion from the highest bit down, then Gray-decoded; the bits are interleaved.
    """
    x = cells.astype(np.uint32).T.copy()   # one row a dimension
    dim = len(x)
    q = np.uint32(1 << (bits - 1))
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(dim):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, dim):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    q = np.uint32(1 << (bits - 1))
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= np.uint32(1)
    x ^= flip
    planes = np.stack([(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)])   # bit, dimension, row
    return np.packbits(planes.reshape(bits * dim, -1).T.astype(np.uint8), axis=1)


def _ranges(dim: int):
    schema = pa.schema([("place", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])

    def run(batches):
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column("v"), dim)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(low), pa.array(high)], schema=schema)

    return run


def _keyed(dim: int, low: np.ndarray, high: np.ndarray):
    """Rows (id, place, v) with their curve keys and integer vectors."""
    schema = pa.schema([("id", pa.int64()), ("place", pa.int64()), ("key", pa.binary()), ("x", pa.list_(pa.int64()))])
    low, wide = low.astype(float), np.maximum(high.astype(float) - low.astype(float), 1.0)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = _integers(part.column("v"), dim)
                cells = np.clip((x - low) / wide * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.uint32)
                keys = [k.tobytes() for k in hilbert_keys(cells, CURVE_BITS)]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim, dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("place"), pa.array(keys, pa.binary()), flat], schema=schema)

    return run


BLOCK_ROW = "ids array<long>, low array<long>, high array<long>, upper array<long>, lower array<long>, x array<long>"


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the upper and lower 32 bits: exact for up to 2**31 rows."""
    return (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)


def _blocks(dim: int):
    """Sorted rows to block rows: ids, zone map, sums and vectors of up to BLOCK consecutive rows."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), *[(c, pa.list_(pa.int64())) for c in ("low", "high", "upper", "lower", "x")]])

    def block(ids: list, x: np.ndarray) -> pa.RecordBatch:
        parts = [ids, x.min(axis=0), x.max(axis=0), *_halves(x), x.ravel()]
        return pa.RecordBatch.from_arrays([pa.array([p], pa.list_(pa.int64())) for p in parts], schema=schema)

    def run(batches):
        ids, held = [], np.empty((0, dim), np.int64)
        for batch in batches:
            ids += batch.column("id").to_pylist()
            held = np.concatenate([held, batch.column("x").flatten().to_numpy().reshape(-1, dim)])
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], held[:BLOCK])
                ids, held = ids[BLOCK:], held[BLOCK:]
        if ids:
            yield block(ids, held)

    return run


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that can be nearest to some point of the box, ascending.

    ``|p-a|^2 - |p-b|^2`` is linear in ``p``; its greatest value over the box takes the
    better edge in each dimension.  Below zero (or zero, if ``a`` is the smaller number)
    ``b`` is nowhere the answer.
    """
    k = len(centroids)
    if max(np.abs(low).max(), np.abs(high).max(), np.abs(centroids).max()) > SAFE:
        return np.arange(k)   # bounds would not be exact: compare with all
    square = (centroids * centroids).sum(axis=1)
    step = 2 * (centroids[None, :, :] - centroids[:, None, :])               # a, b, dimension
    top = np.maximum(step * low, step * high).sum(axis=2) + square[:, None] - square[None, :]
    beaten = (top < 0) | ((top == 0) & (np.arange(k)[:, None] < np.arange(k)[None, :]))
    return np.flatnonzero(~beaten.any(axis=0))


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of each row; ties to the smaller number."""
    c = centroids[among]
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= SAFE:   # every term below is an exact double
        f, g = x.astype(np.float64), c.astype(np.float64)
        d = (f * f).sum(axis=1)[:, None] - 2 * (f @ g.T) + (g * g).sum(axis=1)[None, :]
        best = d.argmin(axis=1)
        return among[best], d[np.arange(len(x)), best].astype(np.int64)
    d = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(r, m, strict=True)) for m in c] for r in x], object)
    best = np.array([min(range(len(c)), key=lambda i: (line[i], i)) for line in d])
    return among[best], np.array([min(int(d[i, b]), _MOST) for i, b in enumerate(best)], np.int64)


def _block_parts(batch: pa.RecordBatch, i: int, dim: int):
    low, high, upper, lower = (batch.column(c)[i].values.to_numpy() for c in ("low", "high", "upper", "lower"))
    return low, high, upper, lower, batch.column("x")[i].values.to_numpy().reshape(-1, dim)


def _sums(dim: int, centroids: np.ndarray):
    """Per task: members and sums of each centroid, and how many vectors the zone maps settled."""
    schema = pa.schema([("cluster", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("upper", pa.int64()), ("lower", pa.int64()), ("settled", pa.int64())])

    def run(batches):
        k = len(centroids)
        n, upper, lower, settled = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                low, high, up, down, x = _block_parts(batch, i, dim)
                among = candidates(low, high, centroids)
                if len(among) == 1:
                    c = among[0]
                    n[c] += len(x)
                    settled[c] += len(x)
                    upper[c] += up
                    lower[c] += down
                    continue
                own, _ = nearest(x, centroids, among)
                for c in np.unique(own).tolist():
                    part = x[own == c]
                    up, down = _halves(part)
                    n[c] += len(part)
                    upper[c] += up
                    lower[c] += down
        c, p = (a.ravel() for a in np.indices((k, dim)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(p.astype(np.int32)), pa.array(n[c]), pa.array(upper.ravel()), pa.array(lower.ravel()), pa.array(settled[c])], schema=schema)

    return run


def _assigned(dim: int, centroids: np.ndarray):
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                low, high, _, _, x = _block_parts(batch, i, dim)
                own, distance = nearest(x, centroids, candidates(low, high, centroids))
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(own.astype(np.int32)), pa.array(distance)], schema=schema)

    return run


def block_table(rows: DataFrame, id_column: str, vector_column: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(vectors, blocks): the rows that take part as (id, place, v), and the Hilbert-ordered blocks."""
    vectors = cut(finite_vectors(rows, id_column, vector_column).where(F.size("v") == dim).withColumn("place", F.monotonically_increasing_id()), "vectors")
    sides = arrow_map(vectors.select("v"), _ranges(dim), "place int, low long, high long").groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("place").collect()
    low, high = (np.array([getattr(r, c) for r in sides] or [0] * dim, np.int64) for c in ("low", "high"))
    keyed = arrow_map(vectors, _keyed(dim, low, high), "id long, place long, key binary, x array<long>")
    return vectors, cut(arrow_map(keyed.orderBy("key", "place").select("id", "x"), _blocks(dim), BLOCK_ROW), "blocks")


def starts(vectors: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """Integer vectors of the ``k`` rows with the smallest hash of ``seed:id``, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.where("id is not null").select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()
    return _integers(pa.array([r.v for r in first], pa.list_(pa.float64())), dim)


ANSWER = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def centroid_clusters(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dim: int = 64,
                      k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``rounds`` times every vector goes to its nearest centroid and every centroid with
    vectors moves to the floor of their mean; then vectors are assigned once more.
    """
    spark = rows.sparkSession
    vectors, blocks = block_table(rows, id_column, vector_column, dim)
    centroids = starts(vectors, k, seed, dim)
    if not len(centroids):
        return spark.createDataFrame([], ANSWER)
    for _ in range(rounds):
        moved = (arrow_map(blocks, _sums(dim, centroids), "cluster int, place int, n long, upper long, lower long, settled long").where("n > 0")
                 .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("upper").alias("upper"), F.sum("lower").alias("lower")))
        centroids = centroids.copy()
        for r in moved.collect():   # one row per centroid and dimension
            centroids[r.cluster, r.place] = ((r.upper << 32) + r.lower) // r.n
    assigned = cut(arrow_map(blocks, _assigned(dim, centroids), "vec_id long, cluster int, distance long"), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    inertia = {r.cluster: int(r.inertia) for r in assigned.groupBy("cluster").agg(exact).collect()}   # one row per centroid
    discard(vectors, blocks)
    total, whole = sum(inertia.values()), lambda v: min(v, _MOST)
    facts = [(c, whole(inertia.get(c, 0)), whole(total), hashlib.sha256(",".join(map(str, m)).encode()).hexdigest()) for c, m in enumerate(centroids.tolist())]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")   # k rows
