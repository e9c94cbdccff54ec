"""Whitening against plain integer sums and numpy's covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.whitening import bit_planes, whitened


def plain(rows, components=32):
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows]
    n, dim = len(x), len(x[0][1])
    sums = [sum(v[d] for _, v in x) for d in range(dim)]
    y = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for _, v in x])
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for _, v in x]
    return n, deviation, values[order], y @ axes[:, order] / np.sqrt(values[order]), values.sum()


def check(spark, rows, expected=None, components=32):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("id", "v", "n", "dim", "place", "component"):
        df = df.withColumn(c, F.lit("x"))
    out = whitened(df, components=components).collect()
    expected = expected or rows
    n, deviation, values, w, trace = plain(expected, components)
    assert len(out) == len(expected) * len(values)
    by = {(r.vec_id, r.component): r for r in out}
    got = np.array([[by[i, c + 1].whitened for c in range(len(values))] for i, _ in expected])
    assert np.allclose(np.abs(got), np.abs(w), rtol=1e-6, atol=1e-8)
    assert np.allclose((got * w).sum(axis=0) ** 2, (w * w).sum(axis=0) ** 2)          # one sign for all rows
    assert {r.n for r in out} == {n}
    assert [int(by[i, 1].deviation) for i, _ in expected] == deviation
    assert np.allclose([by[expected[0][0], c + 1].explained for c in range(len(values))], values / trace, rtol=1e-9)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-6
    assert np.abs(got.T @ got / n - np.eye(len(values))).max() < 1e-6


def test_equals_plain_sums(spark):
    rng = np.random.default_rng(1)
    mixing = rng.standard_normal((7, 7))
    rows = [(i, (rng.standard_normal(7) @ mixing + 3).tolist()) for i in range(300)]
    check(spark, rows)
    check(spark, rows, components=3)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(40)] + [(None, [0.25, 1.0, -2.0, 0.0])]
    odd = [(100, None), (101, [None, 1.0, 2.0, 3.0]), (102, [math.nan] * 4), (103, [math.inf, 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    check(spark, good + odd, good)


def test_repeated_rows_count(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows + [rows[0]] * 20, "vec_id long, embedding array<double>")
    out = whitened(df).collect()
    assert len(out) == 50 * 3 and {r.n for r in out} == {50} and out[0].identity_error < 1e-6
    assert np.isclose(sum(r.explained for r in out) / 50, 1)


def test_values_far_apart_stay_exact(spark):
    """Sums beyond 64 bits; the smallest component has 1e-6 of the largest's deviation."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(3) * [3e9, 2e8, 5e4]).tolist()) for i in range(50)]
    check(spark, rows, components=2)


def test_without_variance_no_component(spark):
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect() == []
    assert whitened(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []
    rows = [(i, [float(i), 7.0]) for i in range(9)]
    out = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out} == {1} and len(out) == 9


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_planes_count_products(n):
    rng = np.random.default_rng(n)
    x = rng.integers(-9, 30, (n, 2))
    low, bits = x.min(axis=0), np.array([int(v).bit_length() for v in x.max(axis=0) - x.min(axis=0)])
    planes = bit_planes(x, low, bits)
    of = np.repeat([0, 1], bits)
    power = np.concatenate([np.arange(b) for b in bits])
    total = sum(int(np.bitwise_count(p & q).sum()) << int(a + b) for p, i, a in zip(planes, of, power, strict=True)
                for q, j, b in zip(planes, of, power, strict=True) if (i, j) == (0, 1))
    assert total == int(((x[:, 0] - low[0]) * (x[:, 1] - low[1])).sum())
