"""Centroid clustering against plain Lloyd rounds; zone maps may save work, never change a result."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import centroids as C
from ledgerlark.llm.centroids import block_table, candidates, centroid_clusters, hilbert_keys, nearest


def brute(rows, dim, k, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, o) in zip(kept, own, strict=True) if o == j]
            if mine:
                cents[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own = assign()
    inertia = [sum(d for d, o in own if o == j) for j in range(len(cents))]
    return sorted(((i, o, d, inertia[o], sum(inertia), hashlib.sha256(",".join(map(str, cents[o])).encode()).hexdigest())
                   for (i, _), (d, o) in zip(kept, own, strict=True)), key=str)


def found(spark, rows, dim, k=8, rounds=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("id", "place", "key", "x", "cluster", "low"):
        df = df.withColumn(c, df.vec_id)
    out = centroid_clusters(df, dim=dim, k=k, rounds=rounds).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out), key=str)


def vectors(seed, n, dim, centres=5, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, dim))
    return [(i, (c[rng.integers(centres)] + spread * rng.standard_normal(dim)).tolist()) for i in range(n)]


def test_equals_plain_rounds_on_awkward_rows(spark):
    rows = vectors(1, 400, 6)
    rows += [(3, rows[7][1])] * 150 + [(500, None), (501, [1.0] * 5), (502, [None] * 6), (503, [math.nan] * 6), (504, [math.inf] * 6), (505, []),
                                       (None, [0.5] * 6), (506, [0.0] * 6), (507, [3.0e5, -2.0e6, 0.0, 0.0, 0.0, 1.0])]
    assert found(spark, rows, 6) == brute(rows, 6, 8, 10)


def test_few_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, -1.0])]
    assert found(spark, rows, 2) == brute(rows, 2, 8, 10)
    assert found(spark, [(1, None)], 2) == [] == found(spark, [(None, [1.0, 2.0])], 2)


def test_ties_go_to_the_smaller_centroid():
    cents = np.array([[4, 0], [0, 0], [4, 0]])
    own, d = nearest(np.array([[2, 0], [4, 1], [0, 5]]), cents, np.arange(3))
    assert own.tolist() == [0, 0, 1] and d.tolist() == [4, 1, 25]


def test_candidates_hold_every_nearest_centroid():
    rng = np.random.default_rng(4)
    settled = 0
    for _ in range(200):
        cents = rng.integers(-50, 50, (6, 3))
        low = rng.integers(-60, 60, 3)
        high = low + rng.integers(0, 25, 3)
        among = candidates(low, high, cents)
        points = rng.integers(low, high + 1, (300, 3))
        assert set(nearest(points, cents, np.arange(6))[0].tolist()) <= set(among.tolist())
        settled += len(among) == 1
    assert settled > 20
    far = np.array([[0, 0], [2**40, 0]])
    assert candidates(np.array([0, 0]), np.array([2**40, 1]), far).tolist() == [0, 1]   # beyond exact bounds: all


def test_zone_maps_settle_blocks_of_clustered_vectors(spark):
    """One centroid in each of five tight clusters: only blocks across two clusters are opened."""
    rows = vectors(2, 4000, 4, spread=0.01)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, blocks = block_table(df, "vec_id", "embedding", 4)
    cents = np.floor(1024 * np.random.default_rng(2).standard_normal((5, 4))).astype(np.int64)
    out = C.arrow_map(blocks, C._sums(4, cents), "cluster int, place int, n long, upper long, lower long, settled long").where("place = 0").groupBy().sum("n", "settled").first()
    assert out[0] == 4000 and out[1] > 2000


def test_large_values_stay_exact():
    x = np.array([[2**40, -(2**41)], [3, 5]])
    own, d = nearest(x, np.array([[2**40 - 1, -(2**41)], [0, 0]]), np.arange(2))
    assert own.tolist() == [0, 1] and d.tolist() == [1, 34]
    assert nearest(np.array([[2**60, 0]]), np.array([[-(2**60), 0]]), np.arange(1))[1].tolist() == [2**63 - 1]


@pytest.mark.parametrize("dim, bits", [(2, 4), (3, 3)])
def test_the_curve_steps_to_a_neighbour(dim, bits):
    cells = np.stack([g.ravel() for g in np.indices((1 << bits,) * dim)], axis=1)
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array(keys, object))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_block_rows_hold_their_box_and_sum(spark):
    rows = vectors(3, 700, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    n = 0
    for b in block_table(df, "vec_id", "embedding", 4)[1].collect():
        x = np.array(b.x).reshape(-1, 4)
        n += len(b.ids)
        assert b.low == x.min(axis=0).tolist() and b.high == x.max(axis=0).tolist()
        assert [(u << 32) + w for u, w in zip(b.upper, b.lower, strict=True)] == x.sum(axis=0).tolist()
    assert n == 700
    assert C._integers(pa.array([[0.5, -0.0005]]), 2).tolist() == [[512, -1]]
