"""K02 on hand-written daily series: history boundary, floors, ties, median/MAD."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerlark.operators.anomalies import METRICS, daily_anomalies, with_frame_stats


def daily_frame(spark, error_rates, n_requests=1000):
    names = [m[0] for m in METRICS]
    dens = {m[3] for m in METRICS if m[3]}
    rows = []
    for i, er in enumerate(error_rates):
        row = {n: 0.5 for n in names}
        row.update({d: 100.0 for d in dens})
        row["error_rate"] = er
        row["n_requests"] = float(n_requests)
        row["metric_date"] = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        row["is_partial_day"] = False
        rows.append(row)
    cols = ["metric_date", "is_partial_day"] + sorted(set(names) | dens)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 "metric_date date, is_partial_day boolean, "
                                 + ", ".join(f"{c} double" for c in cols[2:]))


def error_rows(spark, rates):
    a = daily_anomalies(daily_frame(spark, rates)).where(F.col("metric_name") == "error_rate")
    return {r.metric_date: r for r in a.collect()}


def test_history_boundary_and_flags(spark):
    rates = [0.05] * 7 + [0.5, 0.05]
    rows = error_rows(spark, rates)
    d = dt.date(2024, 1, 1)
    sixth = rows[d + dt.timedelta(days=6)]
    assert sixth.n_history_days == 6 and sixth.robust_z is None and sixth.is_anomaly is False
    spike = rows[d + dt.timedelta(days=7)]
    assert spike.n_history_days == 7 and spike.is_anomaly and spike.is_actionable_anomaly
    assert spike.direction == "high"
    # zero MAD: spread is the binomial floor sqrt(p(1-p)/n)
    assert abs(spike.baseline_spread - np.sqrt(0.05 * 0.95 / 1000)) < 1e-12
    after = rows[d + dt.timedelta(days=8)]
    assert after.direction is None and after.is_anomaly is False and after.is_actionable_anomaly is False


def test_low_side_is_not_actionable_for_high_metric(spark):
    rows = error_rows(spark, [0.3] * 8 + [0.0])
    r = rows[dt.date(2024, 1, 9)]
    assert r.is_anomaly and r.direction == "low" and r.is_actionable_anomaly is False


def test_median_mad_match_numpy(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(vals,)], "v array<double>")
    r = with_frame_stats(df, "v").select(
        F.col("baseline_value").alias("m"), F.col("baseline_mad").alias("d"), F.col("n_history_days").alias("n")
    ).first()
    assert r.m == np.median(vals) and r.n == len(vals)
    assert abs(r.d - np.median(np.abs(np.array(vals) - np.median(vals)))) < 1e-12
