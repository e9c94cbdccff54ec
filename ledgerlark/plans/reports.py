"""Reporting datasets R01-R21: the data behind the dashboard and the incident analysis.

Every function reads published marts only and takes a typed
:class:`ReportFilter` (date range and model list) instead of SQL text with
inlined literals.  Fixed display domains (models, confidence buckets, reasons)
are small literal DataFrames joined from the left, which gives the ordered,
zero-filled re-indexing a plotting layer expects without any driver-side work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import count_where, ratio
from ledgerlark.sources import seeds as SD

# ---------------------------------------------------------------------------
# Display orders of the dashboard panels.
# ---------------------------------------------------------------------------
REASON_DISPLAY_ORDER = ["policy_requires_human", "unresolved_after_retry", "user_requested_agent",
                        "low_confidence", "fraud_suspected", "llm_failure"]
QUALITY_FLAGS = ["orphan_no_conversation", "negative_latency", "token_sum_mismatch", "model_alias_mapped",
                 "duplicate_ingest_deduped", "late_arriving", "cost_not_reconciled"]
TOP_INTENTS = 8
AVG_SCALE = 6
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportFilter:
    start: str | None = None          # inclusive date, None = open
    end: str | None = None            # inclusive date, None = open
    models: tuple[str, ...] | None = None   # None = every catalogue model


def _in_range(c: str, f: ReportFilter) -> Column:
    cond = F.lit(True)
    if f.start is not None:
        cond = cond & (F.col(c) >= F.lit(f.start).cast("date"))
    if f.end is not None:
        cond = cond & (F.col(c) <= F.lit(f.end).cast("date"))
    return cond


def _models(f: ReportFilter) -> list[str]:
    return list(f.models) if f.models is not None else list(SD.MODEL_NAMES)


def _domain(spark, values: list[str], name: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, ord int"))


def _full_days(daily: DataFrame, f: ReportFilter) -> DataFrame:
    return daily.where(~F.col("is_partial_day") & _in_range("metric_date", f))


def kpi_series(daily: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R01 - full days of the daily KPI mart inside the range, ordered by date."""
    return _full_days(daily, f).orderBy("metric_date")


def headline_tiles(daily: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R02 - one row of headline numbers; ratios of sums, CSAT weighted by n_rated."""
    d = _full_days(daily, f)
    weighted = F.round(F.sum(F.col("avg_satisfaction_score") * F.col("n_rated")), AVG_SCALE)
    return d.agg(
        F.sum("n_conversations").alias("conversations"),
        ratio(F.sum("n_auto_resolved"), F.sum("n_conversations")).alias("auto_resolution_rate"),
        ratio(F.sum("n_escalated"), F.sum("n_conversations")).alias("escalation_rate"),
        ratio(weighted, F.sum("n_rated")).alias("avg_csat"),
        F.sum("total_cost_usd").alias("llm_cost_usd"),
        ratio(F.sum("n_failed_requests"), F.sum("n_requests")).alias("error_rate"),
    )


def daily_model_costs(costs: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R03 - the per-model cost ledger inside the range and model selection."""
    return costs.where(_in_range("request_date", f) & F.col("model_name").isin(_models(f))).orderBy("request_date")


def cost_by_model(costs: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R04 - cost, requests, tokens and cost per 1k tokens per model, catalogue-ordered."""
    g = daily_model_costs(costs, f).groupBy("model_name").agg(
        F.sum("total_cost_usd").alias("cost"), F.sum("n_requests").alias("requests"),
        F.sum("total_tokens").alias("tokens"))
    dom = _domain(costs.sparkSession, _models(f), "model_name")
    return dom.join(g, "model_name", "left").select(
        "model_name", "ord", "cost", "requests", "tokens",
        (ratio("cost", "tokens") * F.lit(1000.0)).alias("cost_per_1k_tokens"))


def reliability(rel: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R05 - reliability rows (incl. the p95 series) inside the range and model selection."""
    return rel.where(_in_range("request_date", f) & F.col("model_name").isin(_models(f))).orderBy("request_date")


def failures_by_status(rel: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R06 - failed requests per day and status (unpivot of three counters)."""
    r = reliability(rel, f)
    long = r.select("request_date", F.inline(F.array(*[
        F.struct(F.lit(s).alias("status"), F.col(f"n_{s}_requests").alias("n")) for s in SD.FAILURE_STATUSES
    ])))
    return long.groupBy("request_date", "status").agg(F.sum("n").alias("n"))


def model_scorecard(rel: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R07 - per model: volume, failures, median of the daily p95, 5xx, cost and rates."""
    g = reliability(rel, f).groupBy("model_provider", "model_name", "model_tier").agg(
        F.sum("n_requests").alias("requests"),
        F.sum("n_failed_requests").alias("failed"),
        F.round(F.percentile("p95_latency_ms", 0.5), AVG_SCALE).alias("p95_ms"),
        F.sum("n_provider_5xx").alias("provider_5xx"),
        F.sum("total_cost_usd").alias("cost"),
    )
    return g.select("*", ratio("failed", "requests").alias("error_rate"),
                    ratio("cost", "requests").alias("cost_per_request"))


def anomaly_list(anom: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R08 - flagged metric-days inside the range, by date then |z| descending."""
    return anom.where(F.col("is_anomaly") & _in_range("metric_date", f)).select(
        "metric_date", "metric_name", "metric_kind", "metric_value", "baseline_value", "robust_z", "direction",
        "is_actionable_anomaly",
    ).orderBy("metric_date", F.abs("robust_z").desc())


def metrics_flagged_per_day(anom: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R09 - number of distinct metrics flagged per day."""
    return anomaly_list(anom, f).groupBy("metric_date").agg(
        F.countDistinct("metric_name").alias("n_metrics_flagged"))


def cohort_grid(ret: DataFrame) -> DataFrame:
    """R10 - fully observable cells pivoted to W0..Wn, one row per cohort with its label.

    The last column is the largest observed week, one number read from the
    (catalogue-sized) mart, so no week is left out however long the window is.
    """
    obs = ret.where(F.col("is_fully_observable"))
    max_weeks = obs.agg(F.max("weeks_since_signup")).first()[0]
    max_weeks = -1 if max_weeks is None else int(max_weeks)
    grid = obs.groupBy("signup_week", "cohort_size").pivot("weeks_since_signup", list(range(max_weeks + 1))).agg(
        F.first("retention_rate"))
    label = F.concat(F.date_format("signup_week", "MMM dd"), F.lit("  (n="), F.col("cohort_size").cast("string"),
                     F.lit(")"))
    return grid.select("signup_week", label.alias("cohort_label"),
                       *[F.col(str(w)).alias(f"W{w}") for w in range(max_weeks + 1)])


def retention_curve(ret: DataFrame) -> DataFrame:
    """R11 - mean retention and number of cohorts per week since signup (observable cells)."""
    return ret.where(F.col("is_fully_observable")).groupBy("weeks_since_signup").agg(
        F.round(F.avg("retention_rate"), AVG_SCALE).alias("mean_retention_rate"),
        F.countDistinct("signup_week").alias("n_cohorts"))


def intent_table(iq: DataFrame) -> DataFrame:
    """R12 - per-intent table with its volume order and accuracy order.

    The window runs over the catalogue-sized mart (one row per intent).
    """
    by_volume = Window.orderBy(F.col("n_conversations").desc_nulls_last(), "intent")
    by_accuracy = Window.orderBy(F.col("intent_accuracy").asc_nulls_last(), "intent")
    return iq.select(
        "intent", "intent_category", "risk_level", "n_conversations", "auto_resolution_rate", "escalation_rate",
        "avg_satisfaction_score", "top_escalation_reason", "cost_per_conversation_usd", "intent_accuracy",
        F.row_number().over(by_volume).cast("long").alias("volume_rank"),
        F.row_number().over(by_accuracy).cast("long").alias("accuracy_rank"),
    )


def conversation_cube(conv: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R13 - conversation counts by intent x reason x confidence bucket x flags."""
    keys = ["initial_intent", "escalation_reason", "intent_confidence_bucket", "is_escalated",
            "intent_is_human_reviewed", "intent_is_correct"]
    return conv.where(_in_range("conversation_date", f)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def confidence_distribution(conv: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R14 - conversations per confidence bucket on the fixed 5-bucket domain, zero filled."""
    g = conversation_cube(conv, f).groupBy("intent_confidence_bucket").agg(F.sum("n").alias("n"))
    dom = _domain(conv.sparkSession, SD.CONFIDENCE_BUCKETS, "intent_confidence_bucket")
    return dom.join(g, "intent_confidence_bucket", "left").select(
        "intent_confidence_bucket", "ord", F.coalesce("n", F.lit(0)).alias("n"))


def escalations_top_intents(conv: DataFrame, f: ReportFilter = ReportFilter(), k: int = TOP_INTENTS) -> DataFrame:
    """R15 - escalations by intent and reason for the top-k intents, zero filled.

    Top-k (the feature) is a TakeOrdered over the per-intent totals - at most one
    row per intent - then a semi-join; the (k x reasons) grid is bounded by k
    and the reason domain.
    """
    esc = conversation_cube(conv, f).where(F.col("is_escalated") & F.col("escalation_reason").isNotNull()) \
        .groupBy("initial_intent", "escalation_reason").agg(F.sum("n").alias("n"))
    top = esc.groupBy("initial_intent").agg(F.sum("n").alias("total")) \
        .orderBy(F.col("total").desc(), "initial_intent").limit(k)
    grid = F.broadcast(top.select("initial_intent", "total")).crossJoin(
        _domain(conv.sparkSession, REASON_DISPLAY_ORDER, "escalation_reason"))
    return grid.join(esc.join(top.select("initial_intent"), "initial_intent", "left_semi"),
                     ["initial_intent", "escalation_reason"], "left").select(
        "initial_intent", "escalation_reason", F.col("ord").alias("reason_ord"), "total",
        F.coalesce("n", F.lit(0)).alias("n"))


def data_quality_summary(req: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R16 - flag counts and logged vs recomputed cost over the request mart."""
    r = req.where(_in_range("request_date", f))
    return r.agg(
        F.count(F.lit(1)).alias("requests"),
        count_where(F.col("is_orphan")).alias("orphan_no_conversation"),
        count_where(F.col("has_invalid_latency")).alias("negative_latency"),
        count_where(F.col("has_token_sum_mismatch")).alias("token_sum_mismatch"),
        count_where(F.col("has_model_alias")).alias("model_alias_mapped"),
        count_where(F.col("had_duplicate_ingest")).alias("duplicate_ingest_deduped"),
        count_where(F.col("is_late_arriving")).alias("late_arriving"),
        count_where(~F.col("is_cost_reconciled")).alias("cost_not_reconciled"),
        F.sum("cost_usd").alias("calculated_cost"),
        F.sum("logged_cost_usd").alias("logged_cost"),
    )


def flag_shares(req: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R17 - (flag, rows, share of requests) - unpivot of R16."""
    s = data_quality_summary(req, f)
    long = s.select("requests", F.inline(F.array(*[
        F.struct(F.lit(q).alias("flag"), F.lit(i).alias("ord"), F.col(q).alias("rows"))
        for i, q in enumerate(QUALITY_FLAGS)])))
    return long.select("flag", "ord", "rows", ratio("rows", "requests").alias("share"))


def cost_drift_by_model(costs: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R18 - cost mismatches and logged-minus-recomputed cost per model, catalogue-ordered."""
    g = daily_model_costs(costs, f).groupBy("model_name").agg(
        F.sum("n_cost_mismatches").alias("mismatches"),
        (-F.sum("cost_reconciliation_delta_usd")).alias("delta"))
    dom = _domain(costs.sparkSession, _models(f), "model_name")
    return dom.join(g, "model_name", "left").select(
        "model_name", "ord", F.coalesce("mismatches", F.lit(0)).alias("mismatches"),
        F.coalesce("delta", F.lit(0)).alias("delta"))


def conflicting_flag_counter(conv: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R19 - conversations with contradictory raw flags, out of all, in the range."""
    return conv.where(_in_range("conversation_date", f)).agg(
        count_where(F.col("has_conflicting_resolution")).alias("conflicting"),
        F.count(F.lit(1)).alias("conversations"))


PANEL_COLUMNS = [
    "n_conversations", "n_active_users", "auto_resolution_rate", "escalation_rate", "abandonment_rate",
    "avg_satisfaction_score", "avg_requests_per_conversation", "cost_per_conversation_usd",
    "cost_per_auto_resolved_conversation_usd", "error_rate", "timeout_rate", "p50_latency_ms", "p95_latency_ms",
    "intent_accuracy", "corrected_intent_rate",
]


def kpi_panels(daily: DataFrame, f: ReportFilter = ReportFilter()) -> DataFrame:
    """R20 - the series behind the product-health, cost, reliability and quality panels."""
    return kpi_series(daily, f).select("metric_date", *PANEL_COLUMNS)


def incident_blast_radius(rel: DataFrame, conv: DataFrame, start: str, end: str) -> DataFrame:
    """R21 - per provider-day failure profile joined to the affected conversations."""
    rng = ReportFilter(start, end)
    by_provider = rel.where(_in_range("request_date", rng)).groupBy("request_date", "model_provider").agg(
        F.sum("n_requests").alias("n_requests"),
        ratio(F.sum("n_failed_requests"), F.sum("n_requests")).alias("error_rate"),
        F.max("p95_latency_ms").alias("worst_model_p95_ms"),
        F.sum("n_provider_5xx").alias("n_provider_5xx"),
        F.sum("n_timeout_requests").alias("n_timeouts"),
    )
    failed = F.col("had_failed_request")
    blast = conv.where(_in_range("conversation_date", rng)).groupBy(
        F.col("conversation_date").alias("request_date")).agg(
        F.count(F.lit(1)).alias("conversations"),
        count_where(failed).alias("conversations_with_failure"),
        count_where(F.col("is_escalated") & (F.col("escalation_reason") == "llm_failure"))
        .alias("escalations_due_to_llm_failure"),
        F.round(F.sum(F.when(failed, F.col("cost_usd"))), 2).alias("cost_of_affected_conversations_usd"),
    )
    return by_provider.join(blast, "request_date", "left").select(
        "request_date", "model_provider", "n_requests", F.round("error_rate", 3).alias("error_rate"),
        "worst_model_p95_ms", "n_provider_5xx", "n_timeouts", "conversations", "conversations_with_failure",
        "escalations_due_to_llm_failure", "cost_of_affected_conversations_usd",
    ).orderBy("request_date", F.col("error_rate").desc())
