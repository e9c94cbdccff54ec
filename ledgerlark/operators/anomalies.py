"""K02 / M22 - robust-z anomaly flags on daily KPIs.

Grain: (metric_date, metric_name).  For each metric the baseline is the median
and MAD of the previous ``baseline_days`` full days (or, for spend, the same
weekday over the previous ``baseline_weeks`` weeks); the spread is floored by
the metric's own sampling noise so a flat history cannot make every wiggle an
anomaly.

Plan shape: the 11 metrics are unpivoted in one pass (``inline`` of an array of
structs) - not 11 scans - and the trailing frames are ``collect_list`` windows
partitioned by metric: the input has one row per day and metric, so every
window partition is small whatever the request volume.  Median and MAD of a
frame use array functions (no UDF), interpolating like ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.config import AnomalyParams
from ledgerlark.functions.exprs import ratio

# ---------------------------------------------------------------------------
# The detector's metric list (name, bad side, kind, denominator)
# and the spread floors per kind.
# ---------------------------------------------------------------------------
METRICS = [
    ("error_rate", "high", "proportion", "n_requests"),
    ("timeout_rate", "high", "proportion", "n_requests"),
    ("p95_latency_ms", "high", "ratio", None),
    ("escalation_rate", "high", "proportion", "n_conversations"),
    ("llm_failure_escalation_share", "high", "proportion", "n_escalated"),
    ("n_llm_failure_escalations", "high", "count", None),
    ("cost_per_conversation_usd", "high", "ratio", None),
    ("total_cost_usd", "high", "amount", None),
    ("auto_resolution_rate", "low", "proportion", "n_conversations"),
    ("avg_satisfaction_score", "low", "score", "n_rated"),
    ("intent_accuracy", "low", "proportion", "n_reviewed_predictions"),
]
MAD_TO_SIGMA = 1.4826
SCORE_FLOOR = 0.02
RATIO_FLOOR = 0.05
AMOUNT_FLOOR = 0.10
PROPORTION_CLIP = 1e-6
MIN_SPREAD = 1e-9
# ---------------------------------------------------------------------------


def unpivot_metrics(daily: DataFrame, metrics: list[tuple] = METRICS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Long format (metric_date, keys, metric_name, actionable_direction, metric_kind, value, denominator)."""
    rows = [
        F.struct(
            F.lit(name).alias("metric_name"),
            F.lit(side).alias("actionable_direction"),
            F.lit(kind).alias("metric_kind"),
            F.col(name).cast("double").alias("metric_value"),
            (F.col(den) if den else F.lit(None)).cast("double").alias("denominator"),
        )
        for name, side, kind, den in metrics
    ]
    return daily.select("metric_date", *keys, F.inline(F.array(*rows)))


def interpolated_median(sorted_arr: Column) -> Column:
    """``quantile_cont(x, 0.5)`` of an ascending array (NULL when empty)."""
    n = F.size(sorted_arr)
    pos = (n - F.lit(1)).cast("double") * F.lit(0.5)
    lo = F.floor(pos).cast("int")
    hi = F.ceil(pos).cast("int")
    lo_v = F.element_at(sorted_arr, lo + F.lit(1))
    hi_v = F.element_at(sorted_arr, hi + F.lit(1))
    return F.when(n > 0, lo_v + (hi_v - lo_v) * (pos - lo.cast("double")))


def with_frame_stats(df: DataFrame, values: str) -> DataFrame:
    """Add (baseline_value, baseline_mad, n_history_days): median, MAD and count of the array ``values``.

    One projection per step, so the sorted frame and its median are computed once
    per row and *referenced* by the next step (inlining them would repeat the sort
    inside the deviation lambda and blow the expression up combinatorially).
    """
    sorted_df = df.withColumn("_sorted", F.array_sort(F.col(values)))
    with_med = sorted_df.withColumn("baseline_value", interpolated_median(F.col("_sorted")))
    with_dev = with_med.withColumn(
        "_dev", F.array_sort(F.transform("_sorted", lambda x: F.abs(x - F.col("baseline_value")))))
    return with_dev.select(
        *[c for c in with_dev.columns if c not in ("_sorted", "_dev")],
        interpolated_median(F.col("_dev")).alias("baseline_mad"),
        F.size("_sorted").cast("long").alias("n_history_days"),
    )


def _with_baseline(long: DataFrame, window, min_history: int) -> DataFrame:
    framed = long.select("*", F.collect_list("metric_value").over(window).alias("_history"))
    return with_frame_stats(framed, "_history").drop("_history").withColumn(
        "min_history_days", F.lit(min_history))


def spread_floor(kind: Column, b: Column, den: Column) -> Column:
    p = F.least(F.greatest(b, F.lit(PROPORTION_CLIP)), F.lit(1 - PROPORTION_CLIP))
    return (
        F.when(kind == "proportion", F.sqrt(p * (F.lit(1.0) - p) / F.greatest(den, F.lit(1.0))))
        .when(kind == "score", F.lit(SCORE_FLOOR) * F.abs(b))
        .when(kind == "ratio", F.lit(RATIO_FLOOR) * F.abs(b))
        .when(kind == "count", F.sqrt(F.greatest(b, F.lit(1.0))))
        .when(kind == "amount", F.lit(AMOUNT_FLOOR) * F.abs(b))
    )


def daily_anomalies(daily_kpis: DataFrame, params: AnomalyParams | None = None) -> DataFrame:
    """K02 - flags on the daily product KPIs."""
    return detect(unpivot_metrics(daily_kpis.where(~F.col("is_partial_day"))), (), params)


# The per-provider metrics of X06 (name, bad side, kind, denominator).
PROVIDER_METRICS = [
    ("error_rate", "high", "proportion", "n_requests"),
    ("timeout_rate", "high", "proportion", "n_requests"),
    ("worst_model_p95_ms", "high", "ratio", None),
    ("total_cost_usd", "high", "amount", None),
]


def provider_anomalies(reliability: DataFrame, daily_kpis: DataFrame, params: AnomalyParams | None = None) -> DataFrame:
    """X06 - the same detector per (day, provider, metric), on full days of the reliability mart.

    Rates are ratios of the models' sums; the latency metric is the worst model's p95.
    """
    days = daily_kpis.where(~F.col("is_partial_day")).select("metric_date")
    per_day = reliability.groupBy(F.col("request_date").alias("metric_date"), "model_provider").agg(
        F.sum("n_requests").alias("n_requests"), F.sum("n_failed_requests").alias("_failed"),
        F.sum("n_timeout_requests").alias("_timeouts"), F.max("p95_latency_ms").alias("worst_model_p95_ms"),
        F.sum("total_cost_usd").alias("total_cost_usd"))
    rates = per_day.withColumns({"error_rate": ratio("_failed", "n_requests"), "timeout_rate": ratio("_timeouts", "n_requests")})
    return detect(unpivot_metrics(rates.join(days, "metric_date", "left_semi"), PROVIDER_METRICS, ("model_provider",)),
                  ("model_provider",), params)


def detect(long: DataFrame, keys: tuple[str, ...], params: AnomalyParams | None = None) -> DataFrame:
    """Flags of the series (``keys``, metric_name) of a long frame as from ``unpivot_metrics``."""
    p = params or AnomalyParams()
    trailing = Window.partitionBy(*keys, "metric_name").orderBy("metric_date").rowsBetween(-p.baseline_days, -1)
    weekly = (Window.partitionBy(*keys, "metric_name", F.dayofweek("metric_date")).orderBy("metric_date")
              .rowsBetween(-p.baseline_weeks, -1))
    based = _with_baseline(long.where(F.col("metric_kind") != "amount"), trailing, p.min_history_days).unionByName(
        _with_baseline(long.where(F.col("metric_kind") == "amount"), weekly, p.min_history_weeks)
    )
    x, b, kind = F.col("metric_value"), F.col("baseline_value"), F.col("metric_kind")
    # spread, z and the flag are each projected once and referenced afterwards
    spread = F.greatest(F.lit(MAD_TO_SIGMA) * F.col("baseline_mad"), spread_floor(kind, b, F.col("denominator")),
                        F.lit(MIN_SPREAD))
    scored = based.withColumn("baseline_spread", spread) \
        .withColumn("_z", (x - b) / F.col("baseline_spread")) \
        .withColumn("_enough", F.col("n_history_days") >= F.col("min_history_days"))
    flagged = scored.withColumn("is_anomaly", F.col("_enough") & (F.abs("_z") > F.lit(p.z_threshold)))
    side = F.when(x > b, "high").otherwise("low")
    return flagged.select(
        "metric_date",
        *keys,
        "metric_name",
        "metric_kind",
        "metric_value",
        "denominator",
        "baseline_value",
        "baseline_spread",
        "n_history_days",
        F.when(F.col("_enough"), F.col("_z")).alias("robust_z"),
        F.when(x > b, "high").when(x < b, "low").alias("direction"),
        "actionable_direction",
        "is_anomaly",
        (F.col("is_anomaly") & (side == F.col("actionable_direction"))).alias("is_actionable_anomaly"),
    )
