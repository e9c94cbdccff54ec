"""Exact percentiles by rank selection against numpy's linear interpolation."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.operators.percentiles import Percentile, bucket, exact_percentiles, with_percentiles

WANTED = [Percentile("p0", 0.0), Percentile("p50", 0.5), Percentile("p95", 0.95), Percentile("p100", 1.0),
          Percentile("p95_ok", 0.95, "ok")]


def expected(values, fraction):
    return round(float(np.percentile(values, fraction * 100)), 6) if values else None


def test_percentiles_equal_numpy(spark):
    rng = random.Random(5)
    rows = [("spread", rng.randrange(-50_000, 400_000), rng.random() < 0.7) for _ in range(3000)]
    rows += [("hot", 120 if rng.random() < 0.9 else rng.randrange(1000), None) for _ in range(2000)]
    rows += [("few", v, True) for v in (7, -3, 0)] + [("one", 41, False), ("none", None, True), (None, 9, True), (None, None, False)]
    df = spark.createDataFrame(rows, "k string, v long, ok boolean")
    groups = df.groupBy("k").agg(F.count("v").alias("n"))
    got = {r["k"]: r for r in with_percentiles(groups, df, ["k"], "v", WANTED).collect()}
    assert set(got) == {"spread", "hot", "few", "one", "none", None}
    for k, r in got.items():
        every = [v for g, v, _ in rows if g == k and v is not None]
        ok = [v for g, v, o in rows if g == k and v is not None and o]
        assert r["n"] == len(every)
        for p in WANTED:
            assert r[p.name] == expected(ok if p.where else every, p.fraction), (k, p)


def test_buckets_ascend_and_stay_few(spark):
    values = [*range(-300, 300), *(s * 2 ** e + d for s in (-1, 1) for e in range(9, 62) for d in (-1, 0, 1))]
    df = spark.createDataFrame([(v,) for v in sorted(values)], "v long").select("v", bucket(F.col("v")).alias("b"))
    codes = [r["b"] for r in df.orderBy("v").collect()]
    assert codes == sorted(codes)
    span = spark.range(1_000_000, 2_000_000).select(bucket(F.col("id")).alias("b")).distinct().count()
    assert span <= 66


def test_null_tests_are_not_pushed_into_joins(spark):
    left = spark.range(100).select("id", (F.col("id") * 3).alias("a"))
    right = spark.range(100).select(F.col("id").alias("rid"), F.col("id").alias("c"))
    rows = left.join(right, left.id == right.rid).select((F.col("id") % 2).alias("k"), (F.col("a") + F.col("c")).alias("v"))
    plan = exact_percentiles(rows, ["k"], "v", WANTED[:2])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "log1p" not in "".join(line for line in plan.splitlines() if "join" in line or "filter" in line)
