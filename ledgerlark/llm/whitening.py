"""Whitened embeddings from a bit-sliced scatter matrix.

Every component ``c`` becomes the integer ``x = floor(64 * c) + 1000000``.  The
second moments of the x-vectors are counted, not multiplied:

1. *Ranges.*  The least and greatest ``x`` of each dimension (one aggregate).
2. *Scatter.*  Each task shifts a dimension by its least value, so that few bits
   remain, and packs each bit plane across rows into 64-bit words.  The popcount of
   the AND of two planes, weighted by the power of two of their bits, is their share of
   the exact cross-product.  A task emits one count per pair of dimensions and power,
   whatever its number of rows; Spark adds the counts.
3. *Centring.*  ``n * sum(x_i * x_j) - S_i * S_j`` in integers of any size, on
   matrices of dimension x dimension; only then ``eigh``.
4. *Whitening.*  Rows are projected as ``(n * x - S) / n``; a further pass measures the
   covariance of the whitened values.

The driver sees one row per dimension, and one per pair of dimensions and power of
two: bounded by the dimension, never by the rows.

Defined results: vectors that are null or hold null or non-finite entries are
dropped.  Of the rest those of the most frequent length (of ties the longer) are the
fit list; others, and empty ones, are left out, since they have no covariance with
them.  Repeated rows count as often as they stand there, null ids are ids like any
other.  ``floor(64 * c)`` is held within +-2**61, beyond which no long can hold it.  Components
without variance (eigenvalue at most 1e-11 of the largest, so a constant dimension, a single vector)
cannot be whitened and are not returned; no vectors: no rows.  ``deviation`` is a
decimal of 38 digits, as exact as the integers behind it; the query casts it to long
(null where it does not fit).  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, cut

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Smallest share of the largest eigenvalue that counts as variance.
FLAT = 1e-11
#: Rows packed into planes at once: 256 words a plane.
ROWS = 16_384
_EDGE = float(2**61)


def finite_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the vectors without null or non-finite entries, components as double."""
    v = F.col("v")
    out = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return out.where(v.isNotNull() & ~odd)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """x-vectors of an Arrow list column, one row each."""
    c = column.flatten().to_numpy().reshape(-1, dim)
    return np.floor(np.clip(c * SCALE, -_EDGE, _EDGE)).astype(np.int64) + OFFSET


def _ranges():
    """Per task: rows, least and greatest component by vector length and place."""
    schema = pa.schema([("dim", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def run(batches):
        seen: dict[int, list] = {}
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes).tolist():
                x = integers(batch.column("v").filter(pa.array(sizes == dim)), dim)
                n, low, high = seen.get(dim, (0, x[0], x[0]))
                seen[dim] = (n + len(x), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        for dim, (n, low, high) in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)), pa.array(low), pa.array(high)], schema=schema)

    return run


def bit_planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """One row of 64-bit words for each bit of each dimension of ``x - low``, rows of ``x`` along the words."""
    words = -(-len(x) // 64)
    shifted = (x - low).view(np.uint64)   # high - low < 2**63
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, n in enumerate(bits.tolist()):
        for b in range(n):
            packed = np.packbits((shifted[:, d] >> np.uint64(b)).astype(np.uint8) & 1)
            planes[at, : len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


def _scatter(low: np.ndarray, bits: np.ndarray):
    """Per task: counts by (dimension, dimension, power of two); ``second`` -1: the plain sums."""
    schema = pa.schema([("first", pa.int32()), ("second", pa.int32()), ("power", pa.int32()), ("n", pa.int64())])
    dim = len(low)
    of = np.repeat(np.arange(dim), bits)                             # dimension of each plane
    power = np.concatenate([np.arange(b) for b in bits.tolist()]) if bits.sum() else np.empty(0, np.int64)

    def run(batches):
        top = int(bits.max(initial=0))
        products = np.zeros((dim, dim, max(1, 2 * top - 1)), np.int64)
        sums = np.zeros((dim, max(1, top)), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                planes = bit_planes(integers(batch.column("v").slice(lo, ROWS), dim), low, bits)
                for p in range(len(planes)):
                    counts = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
                    # Planes of one dimension meet in both orders; (p, q) with p < q stands for (q, p) too.
                    twice = (of[p:] == of[p]) & (np.arange(p, len(planes)) > p)
                    products[of[p], of[p:], power[p] + power[p:]] += counts * (1 + twice)
                    sums[of[p], power[p]] += counts[0]
        a, b, s = np.nonzero(products)
        d, t = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, d]).astype(np.int32)), pa.array(np.concatenate([b, np.full(len(d), -1)]).astype(np.int32)),
             pa.array(np.concatenate([s, t]).astype(np.int32)), pa.array(np.concatenate([products[a, b, s], sums[d, t]]))], schema=schema)

    return run


def _whiten(n: int, sums: list[int], axes: np.ndarray, low: np.ndarray, high: np.ndarray):
    """x-vectors to their whitened values and exact deviations."""
    dim = len(sums)
    # Widest n * x - S of any dimension: within 2**53 it is an exact double, and so are the squares' sums within 2**62.
    widest = max((max(abs(n * int(h) - s), abs(n * int(lo) - s)) for s, lo, h in zip(sums, low, high, strict=True)), default=0)
    safe = dim * widest**2 < 2**62 and n * max(abs(int(low.min())), abs(int(high.max()))) < 2**62

    def run(x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        if safe:
            y = x * n - np.array(sums, np.int64)
            return (y / n) @ axes, (y * y).sum(axis=1).tolist()
        y = x.astype(object) * n - np.array(sums, object)
        return (y / n).astype(np.float64) @ axes, [int(v) for v in (y * y).sum(axis=1)]

    return run


def _moments(whiten, dim: int, count: int):
    """Per task: sums and cross-products of the whitened values."""
    schema = pa.schema([("first", pa.int32()), ("second", pa.int32()), ("total", pa.float64())])

    def run(batches):
        sums, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                w, _ = whiten(integers(batch.column("v").slice(lo, ROWS), dim))
                sums += w.sum(axis=0)
                products += w.T @ w
        i, j = (a.ravel() for a in np.indices((count, count)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(count)]).astype(np.int32)), pa.array(np.concatenate([j, np.full(count, -1)]).astype(np.int32)),
             pa.array(np.concatenate([products.ravel(), sums]))], schema=schema)

    return run


def _answers(whiten, dim: int, count: int):
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", pa.string()), ("whitened", pa.float64())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                w, deviation = whiten(integers(part.column("v"), dim))
                place = np.repeat(np.arange(len(w)), count)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(place)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(w))),
                     pa.array([str(v) for v in deviation], pa.string()).take(pa.array(place)), pa.array(w.ravel())], schema=schema)

    return run


ANSWER = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), up to ``components`` per vector.

    Components are numbered from 1 by falling eigenvalue ``e`` of the covariance of the
    x-vectors; ``whitened`` is the centred vector's projection over ``sqrt(e)``, ``explained`` is
    ``e`` over the trace, ``deviation`` the exact sum over dimensions of ``(n*x - S)**2``,
    ``identity_error`` the largest entry of the whitened values' covariance minus the identity.
    """
    spark = rows.sparkSession
    vectors = cut(finite_vectors(rows, id_column, vector_column).withColumn("dim", F.size("v")).where("dim > 0"), "finite")
    ranges = (arrow_map(vectors.select("dim", "v"), _ranges(), "dim int, place int, n long, low long, high long")
              .groupBy("dim", "place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
    ranges = cut(ranges, "ranges")
    most = ranges.where("place = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return spark.createDataFrame([], ANSWER)
    dim, n = most.dim, most.n
    sides = ranges.where(F.col("dim") == dim).orderBy("place").collect()   # one row a dimension
    low, high = (np.array([getattr(r, c) for r in sides], np.int64) for c in ("low", "high"))
    bits = np.array([(int(h) - int(lo)).bit_length() for lo, h in zip(low, high, strict=True)])
    fit = vectors.where(F.col("dim") == dim).select("id", "v")

    counts = (arrow_map(fit.select("v"), _scatter(low, bits), "first int, second int, power int, n long")
              .groupBy("first", "second").agg(F.collect_list(F.struct("power", "n")).alias("powers")))
    shifted, products = [0] * dim, {}
    for r in counts.collect():   # one row per pair of dimensions
        total = sum(p.n << p.power for p in r.powers)
        if r.second < 0:
            shifted[r.first] = total
        else:
            products[r.first, r.second] = total
    # n * sum(x_i x_j) - S_i S_j does not change with the shift, so the shifted integers serve.
    centred = [[n * products.get((min(i, j), max(i, j)), 0) - shifted[i] * shifted[j] for j in range(dim)] for i in range(dim)]
    values, axes = np.linalg.eigh(np.array([[c / (n * n) for c in line] for line in centred]))
    trace = sum(centred[i][i] for i in range(dim)) / (n * n)
    order = [i for i in range(dim - 1, -1, -1) if values[i] > FLAT * values[-1]][:components] if trace > 0 else []
    if not order:
        return spark.createDataFrame([], ANSWER)
    explained = [float(values[i] / trace) for i in order]
    whiten = _whiten(n, [s + n * int(lo) for s, lo in zip(shifted, low, strict=True)], axes[:, order] / np.sqrt(values[order]), low, high)

    count = len(order)
    moments = arrow_map(fit.select("v"), _moments(whiten, dim, count), "first int, second int, total double").groupBy("first", "second").agg(F.sum("total").alias("total"))
    sums, cov = np.zeros(count), np.zeros((count, count))
    for r in moments.collect():   # one row per pair of components
        if r.second < 0:
            sums[r.first] = r.total
        else:
            cov[r.first, r.second] = r.total
    error = float(np.abs(cov / n - np.outer(sums / n, sums / n) - np.eye(count)).max())

    share = F.element_at(F.array(*[F.lit(e) for e in explained]), F.col("component"))
    return arrow_map(fit, _answers(whiten, dim, count), "vec_id long, component int, deviation string, whitened double").select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
