"""Cross-mart invariants Q10-Q19 (each returns its violating rows) and S10 freshness.

Scalar comparisons are 1-row aggregates cross-joined together (proven single
rows, broadcast), never collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import ratio

TOLERANCE_USD = 0.0001
ACCURACY_TOLERANCE = 0.0001
INCIDENT_METRICS = ("error_rate", "timeout_rate", "p95_latency_ms")


def cohort_sizes_match_users(retention: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Q10 - every cohort's size equals the number of users of that signup week."""
    cohorts = retention.select("signup_week", "cohort_size").distinct()
    users = dim_users.groupBy("signup_week").agg(F.count(F.lit(1)).alias("n_users"))
    j = cohorts.join(users, "signup_week", "left")
    return j.where(F.col("cohort_size") != F.coalesce("n_users", F.lit(0))).select(
        "signup_week", "cohort_size", "n_users")


def conversation_cost_matches_ledger(fct_conv: DataFrame, fct_req: DataFrame) -> DataFrame:
    """Q11 - conversation cost equals the cost of all non-orphan requests."""
    conv = fct_conv.agg(F.sum("cost_usd").alias("conversation_cost"))
    req = fct_req.where(~F.col("is_orphan")).agg(F.sum("cost_usd").alias("request_cost"))
    j = conv.crossJoin(F.broadcast(req))
    delta = F.col("conversation_cost") - F.col("request_cost")
    return j.select("conversation_cost", "request_cost", delta.alias("delta_usd")).where(
        F.abs(F.col("delta_usd")) > F.lit(TOLERANCE_USD))


def cost_mismatch_rate_within_slo(daily: DataFrame, slo: float = 0.02) -> DataFrame:
    """Q12 - days on which more than ``slo`` of requests have an unreconciled cost."""
    rate = ratio("n_cost_mismatches", "n_requests")
    return daily.where(F.col("n_requests") > 0).select(
        "metric_date", "n_requests", "n_cost_mismatches", rate.alias("mismatch_rate")
    ).where(F.col("mismatch_rate") > F.lit(slo))


def daily_cost_reconciles(daily: DataFrame, model_costs: DataFrame) -> DataFrame:
    """Q13 - KPI mart vs per-model ledger, day by day (full outer join)."""
    product = daily.select(F.col("metric_date").alias("d"), F.col("total_cost_usd").alias("product_cost"))
    ledger = model_costs.groupBy(F.col("request_date").alias("d")).agg(F.sum("total_cost_usd").alias("ledger_cost"))
    j = product.join(ledger, "d", "full_outer")
    delta = F.coalesce("product_cost", F.lit(0)) - F.coalesce("ledger_cost", F.lit(0))
    return j.select(F.col("d").alias("metric_date"), "product_cost", "ledger_cost", delta.alias("delta_usd")).where(
        F.abs(F.col("delta_usd")) > F.lit(TOLERANCE_USD))


def every_request_date_has_daily_row(fct_req: DataFrame, daily: DataFrame) -> DataFrame:
    """Q14 - request dates missing from the daily KPI mart."""
    days = daily.select(F.col("metric_date").alias("request_date"))
    per_date = fct_req.groupBy("request_date").agg(F.count(F.lit(1)).alias("n_requests"))
    return per_date.join(days, "request_date", "left_anti")


def intent_accuracy_consistent(daily: DataFrame, intent_quality: DataFrame) -> DataFrame:
    """Q15 - overall intent accuracy agrees between the daily and per-intent marts."""
    def acc(df: DataFrame, name: str) -> DataFrame:
        return df.agg(ratio(F.sum("n_correct_predictions"), F.sum("n_reviewed_predictions")).alias(name))
    j = acc(daily, "daily_accuracy").crossJoin(F.broadcast(acc(intent_quality, "intent_mart_accuracy")))
    return j.where(F.abs(F.col("daily_accuracy") - F.col("intent_mart_accuracy")) > F.lit(ACCURACY_TOLERANCE))


def retention_week0_recomputed(retention: DataFrame, dim_users: DataFrame, fct_conv: DataFrame) -> DataFrame:
    """Q16 - week-0 retained users equal an independent range-join recomputation."""
    u = dim_users.select("user_id", "signup_week", "signup_date")
    c = fct_conv.select("user_id", "conversation_date")
    j = u.join(c, "user_id").where(
        (F.col("conversation_date") >= F.col("signup_date"))
        & (F.col("conversation_date") <= F.date_add("signup_date", 6)))
    recomputed = j.select("signup_week", "user_id").distinct().groupBy("signup_week").agg(
        F.count(F.lit(1)).alias("n_week0_users"))
    mart = retention.where(F.col("weeks_since_signup") == 0).select("signup_week", "n_retained_users")
    m = mart.join(recomputed, "signup_week", "left")
    return m.where(F.col("n_retained_users") != F.coalesce("n_week0_users", F.lit(0))).select(
        "signup_week", "n_retained_users", "n_week0_users")


def anomaly_detector_flags_incident(anomalies: DataFrame, incident_date: str) -> DataFrame:
    """Q17 - the incident day is flagged on three metrics; error_rate fires on <= 1 other day."""
    spark = anomalies.sparkSession
    expected = spark.createDataFrame([(m,) for m in INCIDENT_METRICS], "metric_name string")
    hits = anomalies.where((F.col("metric_date") == F.lit(incident_date).cast("date"))
                           & F.col("is_actionable_anomaly")).select("metric_name")
    missed = expected.join(hits, "metric_name", "left_anti").select(
        "metric_name", F.lit("no actionable flag on the incident date").alias("problem"))
    others = anomalies.where((F.col("metric_name") == "error_rate") & F.col("is_anomaly")
                             & (F.col("metric_date") != F.lit(incident_date).cast("date")))
    noisy = others.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(
        F.lit("error_rate").alias("metric_name"),
        F.concat(F.col("n").cast("string"), F.lit(" flags outside the incident date")).alias("problem"))
    return missed.unionByName(noisy)


def conflicting_raw_flags(fct_conv: DataFrame) -> DataFrame:
    """Q18 (warn) - conversations whose raw feed said both resolved and escalated."""
    return fct_conv.where(F.col("has_conflicting_resolution")).select(
        "conversation_id", "started_at", "initial_intent", "resolution_status")


def unreconciled_request_costs(fct_req: DataFrame) -> DataFrame:
    """Q19 (warn) - requests whose logged cost is outside tolerance of the recomputation."""
    return fct_req.where(~F.col("is_cost_reconciled")).select(
        "request_id", "request_date", "model_name", "logged_cost_usd",
        F.col("cost_usd").alias("calculated_cost_usd"), "cost_delta_pct")


SQL_CHECKS = [
    ("check_cohort_sizes", "error"),
    ("check_conversation_cost_ledger", "error"),
    ("check_cost_mismatch_slo", "error"),
    ("check_daily_cost_reconciliation", "error"),
    ("check_request_dates_covered", "error"),
    ("check_intent_accuracy_consistency", "error"),
    ("check_retention_week0", "error"),
    ("check_incident_detection", "error"),
    ("warn_conflicting_resolution", "warn"),
    ("warn_unreconciled_costs", "warn"),
]


#: SQL check -> the invariant, the datasets it compares, the values of the configuration it takes.
SQL_CHECK_INPUTS = {
    "check_cohort_sizes": (cohort_sizes_match_users, ("fct_weekly_cohort_retention", "dim_users"), ()),
    "check_conversation_cost_ledger": (conversation_cost_matches_ledger, ("fct_conversations", "fct_llm_requests"), ()),
    "check_cost_mismatch_slo": (cost_mismatch_rate_within_slo, ("fct_daily_product_metrics",), ("cost_mismatch_slo",)),
    "check_daily_cost_reconciliation": (daily_cost_reconciles, ("fct_daily_product_metrics", "fct_daily_model_costs"), ()),
    "check_request_dates_covered": (every_request_date_has_daily_row, ("fct_llm_requests", "fct_daily_product_metrics"), ()),
    "check_intent_accuracy_consistency": (intent_accuracy_consistent, ("fct_daily_product_metrics", "mart_intent_quality"), ()),
    "check_retention_week0": (
        retention_week0_recomputed, ("fct_weekly_cohort_retention", "dim_users", "fct_conversations"), ()),
    "check_incident_detection": (anomaly_detector_flags_incident, ("mart_daily_anomalies",), ("incident_date",)),
    "warn_conflicting_resolution": (conflicting_raw_flags, ("fct_conversations",), ()),
    "warn_unreconciled_costs": (unreconciled_request_costs, ("fct_llm_requests",), ()),
}


def sql_check_frame(wh, name: str) -> DataFrame:
    """Violating rows of one SQL check over a warehouse's marts."""
    invariant, marts, values = SQL_CHECK_INPUTS[name]
    return invariant(*(wh.dataset(m) for m in marts), *(getattr(wh.config, v) for v in values))


def sql_check_frames(wh) -> dict[str, DataFrame]:
    """Violating rows of every SQL check over a warehouse's marts."""
    return {name: sql_check_frame(wh, name) for name, _sev in SQL_CHECKS}


def sql_check_results(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per SQL check in the suite's result schema."""
    from ledgerlark.operators.checks import with_status

    parts = [
        frames[name].agg(
            F.lit(name).alias("check_name"), F.lit("marts").alias("dataset"), F.lit("test").alias("layer"),
            F.lit("sql").alias("kind"), F.lit(sev).alias("severity"), F.count(F.lit(1)).alias("n_violations"),
        )
        for name, sev in SQL_CHECKS
    ]
    return with_status(reduce(DataFrame.unionByName, parts))


def source_freshness(feeds_loaded_at: dict[str, DataFrame], as_of: str | DataFrame, warn_hours: int = 24,
                     error_hours: int = 72) -> DataFrame:
    """S10 - age of the newest ``_loaded_at`` per landing table vs warn/error thresholds.

    ``as_of``: a timestamp as text, or a one-row frame with the column ``as_of``.
    An empty table has no newest load and is an error.
    """
    parts = [
        df.agg(F.max("_loaded_at").alias("max_loaded_at")).select(F.lit(name).alias("table_name"), "max_loaded_at")
        for name, df in feeds_loaded_at.items()
    ]
    out = reduce(DataFrame.unionByName, parts)
    if isinstance(as_of, DataFrame):
        out = out.crossJoin(F.broadcast(as_of.select("as_of")))   # one row
    else:
        out = out.withColumn("as_of", F.lit(as_of).cast("timestamp"))
    age_h = (F.unix_timestamp("as_of") - F.unix_timestamp("max_loaded_at")) / F.lit(3600.0)
    return out.select(
        "table_name", "max_loaded_at", age_h.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age_h > error_hours), "error")
        .when(age_h > warn_hours, "warn").otherwise("pass").alias("status"),
    )
