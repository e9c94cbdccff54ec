"""Mart datasets M12-M18, M20, M21 (K01 and K02 live in cohorts / anomalies).

Every ratio is a DOUBLE division of additive parts (``ratio``), never an
average of averages - except ``mart_intent_quality.avg_latency_ms`` which is the
reference's mean of per-conversation means (kept for parity, flagged here).
Averages of doubles depend on summation order, so they are published rounded
to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import count_where, days_between, full_day_name, ratio, sum_where, week_start
from ledgerlark.operators.intermediate import LATENCY_PERCENTILES, int_model_costs
from ledgerlark.operators.percentiles import Percentile, with_percentiles
from ledgerlark.operators.staging import BASE_COLUMNS, derived_columns

DOUBLE_AVG_SCALE = 6


def conversation_facts(conversations: DataFrame, rollup: DataFrame, quality: DataFrame) -> DataFrame:
    """Conversation grain + quality + request rollup, all joined on conversation_id.

    Rollup columns keep their NULLs (``rollup_*``) so consumers can choose
    between "no request" and zero.  All three inputs are hash-partitioned on
    conversation_id, so the two joins share one partitioning.
    """
    q = quality.drop(
        "initial_intent", "resolution_status", "is_escalated", "is_auto_resolved",
        "has_conflicting_resolution", "satisfaction_score", "has_satisfaction_score",
    )
    r = rollup.select("conversation_id", *[F.col(c).alias(f"rollup_{c}") for c in rollup.columns if c != "conversation_id"])
    return conversations.join(r, "conversation_id", "left").join(q, "conversation_id", "left")


def dim_users(users: DataFrame, conv_facts: DataFrame) -> DataFrame:
    """M12 - one row per user with lifetime assistant activity."""
    activity = conv_facts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_conversations"),
        F.min("started_at").alias("first_conversation_at"),
        F.max("started_at").alias("last_conversation_at"),
        count_where(F.col("is_escalated")).alias("n_escalated_conversations"),
        F.avg(F.col("satisfaction_score").cast("double")).alias("avg_satisfaction_score"),
        F.sum("rollup_cost_usd").alias("lifetime_llm_cost_usd"),
    )
    j = users.join(activity, "user_id", "left")
    return j.select(
        "user_id",
        F.col("created_at").alias("signup_at"),
        "signup_date",
        "signup_week",
        "country_code",
        "segment",
        "signup_channel",
        F.coalesce("n_conversations", F.lit(0)).alias("n_conversations"),
        "first_conversation_at",
        "last_conversation_at",
        F.coalesce("n_escalated_conversations", F.lit(0)).alias("n_escalated_conversations"),
        "avg_satisfaction_score",
        F.coalesce("lifetime_llm_cost_usd", F.lit(0)).alias("lifetime_llm_cost_usd"),
        F.col("n_conversations").isNotNull().alias("has_used_assistant"),
        days_between("signup_date", F.col("first_conversation_at").cast("date")).alias("days_to_first_conversation"),
    )


def dim_models(model_catalog: DataFrame, prices: DataFrame, priced: DataFrame) -> DataFrame:
    """M13 - catalogue-driven model dimension with current price and usage."""
    latest = prices.groupBy("model_name").agg(
        F.max_by("input_price_per_1k_tokens", "price_date").alias("current_input_price_per_1k_tokens"),
        F.max_by("output_price_per_1k_tokens", "price_date").alias("current_output_price_per_1k_tokens"),
        (F.countDistinct("input_price_per_1k_tokens") - F.lit(1)).alias("n_price_changes"),
        F.min("price_date").alias("priced_from"),
        F.max("price_date").alias("priced_to"),
    )
    usage = priced.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.min("created_at").alias("first_seen_at"),
        F.max("created_at").alias("last_seen_at"),
        count_where(F.col("has_model_alias")).alias("n_requests_via_alias"),
    )
    j = model_catalog.join(latest, "model_name", "left").join(usage, "model_name", "left")
    return j.select(
        "model_name", "model_provider", "model_tier", "context_window_tokens",
        "current_input_price_per_1k_tokens", "current_output_price_per_1k_tokens", "n_price_changes",
        "priced_from", "priced_to",
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"),
        "first_seen_at", "last_seen_at",
        F.coalesce("n_requests_via_alias", F.lit(0)).alias("n_requests_via_alias"),
    )


def dim_intents(intent_catalog: DataFrame, conversations: DataFrame) -> DataFrame:
    """M14 - catalogue-driven intent dimension with observed volume."""
    observed = conversations.groupBy(F.col("initial_intent").alias("intent")).agg(
        F.count(F.lit(1)).alias("n_conversations"),
        F.min("started_at").alias("first_seen_at"),
        F.max("started_at").alias("last_seen_at"),
    )
    j = intent_catalog.join(observed, "intent", "left")
    return j.select(
        "intent", "intent_category", "risk_level", "requires_human_policy", "description",
        F.coalesce("n_conversations", F.lit(0)).alias("n_conversations"),
        "first_seen_at", "last_seen_at",
    )


def fct_conversations(conv_facts: DataFrame, users: DataFrame) -> DataFrame:
    """M15 - one row per conversation; conversations without requests are kept."""
    u = users.select(
        "user_id",
        F.col("segment").alias("user_segment"),
        F.col("country_code").alias("user_country_code"),
        F.col("signup_channel").alias("user_signup_channel"),
        F.col("signup_week").alias("user_signup_week"),
    )
    j = conv_facts.join(u, "user_id", "left")
    z = lambda c: F.coalesce(F.col(f"rollup_{c}"), F.lit(0)).alias(c)
    return j.select(
        "conversation_id", "user_id", "user_segment", "user_country_code", "user_signup_channel",
        "user_signup_week", "started_at", "ended_at", "conversation_date", "duration_seconds", "channel",
        "initial_intent", "resolution_status", "is_auto_resolved", "is_escalated",
        (F.col("resolution_status") == "abandoned").alias("is_abandoned"),
        "has_conflicting_resolution", "satisfaction_score", "has_satisfaction_score",
        "escalation_reason", "handled_by_team", "time_to_handoff_seconds",
        "predicted_intent",
        F.col("confidence").alias("intent_confidence"),
        F.col("confidence_bucket").alias("intent_confidence_bucket"),
        F.col("is_human_reviewed").alias("intent_is_human_reviewed"),
        F.col("is_correct").alias("intent_is_correct"),
        F.col("is_corrected").alias("intent_is_corrected"),
        z("n_requests"), z("n_successful_requests"), z("n_failed_requests"),
        F.coalesce("rollup_had_failed_request", F.lit(False)).alias("had_failed_request"),
        z("n_distinct_models"),
        F.col("rollup_first_model_name").alias("first_model_name"),
        F.col("rollup_last_model_name").alias("last_model_name"),
        z("prompt_tokens"), z("completion_tokens"), z("total_tokens"), z("cost_usd"),
        F.col("rollup_avg_latency_ms").alias("avg_latency_ms"),
        F.col("rollup_max_latency_ms").alias("max_latency_ms"),
        F.col("rollup_total_latency_ms").alias("total_latency_ms"),
        F.coalesce("rollup_had_data_quality_issue", F.lit(False)).alias("had_data_quality_issue"),
    )


def left_join_nullable_key(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """J03 - left join on a nullable text key without funnelling NULL keys into one task.

    Rows with a NULL key can never match: they are spread over the tasks by ``spread_by`` and
    the condition keeps them from every match.  ``left`` is read once, not once for the keyed
    rows and once for the others.
    """
    spread = left.withColumn("_key", F.coalesce(key, spread_by))
    other = right.withColumnRenamed(key, "_right")
    return spread.join(other, (spread["_key"] == other["_right"]) & spread[key].isNotNull(), "left").drop("_key", "_right")


def fct_llm_requests(requests: DataFrame, conversations: DataFrame, model_catalog: DataFrame, prices: DataFrame) -> DataFrame:
    """M16 - one row per deduplicated request with cost and conversation context.

    Every request travels to its conversation, so it does with the columns that the others follow from;
    flags, buckets and costs are made of them after the join.
    """
    c = conversations.select("conversation_id", "user_id", "channel", "initial_intent",
                             F.col("resolution_status").alias("conversation_resolution_status"))
    j = left_join_nullable_key(requests.select(*BASE_COLUMNS), c, "conversation_id", "request_id")
    j = int_model_costs(derived_columns(j, [x for x in c.columns if x != "conversation_id"]), prices)
    m = F.broadcast(model_catalog.select("model_name", "model_tier"))  # fixed seed
    j = j.join(m, "model_name", "left")
    return j.select(
        "request_id", "conversation_id", "user_id", "created_at", "ingested_at", "request_date", "channel",
        "initial_intent", "conversation_resolution_status", "model_provider", "model_name", "model_tier",
        "model_name_raw", "status", "error_type", "is_success", "is_failed", "prompt_tokens",
        "completion_tokens", "total_tokens", "token_bucket", "latency_ms", "latency_bucket",
        "input_price_per_1k_tokens", "output_price_per_1k_tokens",
        F.col("calculated_cost_usd").alias("cost_usd"),
        F.col("recorded_cost_usd").alias("logged_cost_usd"),
        "cost_delta_usd", "cost_delta_pct", "is_cost_reconciled", "is_orphan", "has_invalid_latency",
        "has_token_sum_mismatch", "has_model_alias", "had_duplicate_ingest", "is_late_arriving",
    )


def requests_with_tier(priced: DataFrame, model_catalog: DataFrame) -> DataFrame:
    """The M16 columns that the per-model day marts read: requests, costs and tier, no conversation."""
    m = F.broadcast(model_catalog.select("model_name", "model_tier"))  # fixed seed
    return priced.withColumnsRenamed(
        {"calculated_cost_usd": "cost_usd", "recorded_cost_usd": "logged_cost_usd"}).join(m, "model_name", "left")


def daily_ratios(d: DataFrame) -> dict[str, F.Column]:
    """The KPI ratios of M17, from additive components (shared with X03 roll-ups)."""
    c = F.col
    return {
        "auto_resolution_rate": ratio("n_auto_resolved", "n_conversations"),
        "escalation_rate": ratio("n_escalated", "n_conversations"),
        "llm_failure_escalation_share": ratio("n_llm_failure_escalations", "n_escalated"),
        "abandonment_rate": ratio("n_abandoned", "n_conversations"),
        "avg_satisfaction_score": ratio("satisfaction_score_sum", "n_rated"),
        "rating_response_rate": ratio("n_rated", "n_conversations"),
        "avg_requests_per_conversation": ratio("n_requests_in_conversations", "n_conversations"),
        "error_rate": ratio("n_failed_requests", "n_requests"),
        "timeout_rate": ratio("n_timeout_requests", "n_requests"),
        "avg_latency_ms": ratio("latency_ms_sum", "n_latency_samples"),
        "cost_per_request_usd": ratio("cost_usd", "n_requests"),
        "cost_per_conversation_usd": ratio("conversation_cost_usd", "n_conversations"),
        "cost_per_auto_resolved_conversation_usd": ratio("conversation_cost_usd", "n_auto_resolved"),
        "cost_per_1k_tokens_usd": ratio("cost_usd", "total_tokens") * F.lit(1000.0),
        "intent_accuracy": ratio("n_correct_predictions", "n_reviewed_predictions"),
        "corrected_intent_rate": ratio("n_corrected_predictions", "n_reviewed_predictions"),
        "cost_reconciliation_delta_usd": c("cost_usd") - c("logged_cost_usd"),
    }


def fct_daily_product_metrics(daily: DataFrame) -> DataFrame:
    """M17 - daily KPIs; trailing days without conversations are partial days.

    The last full day is a 1-row aggregate cross-joined back (broadcast of a
    proven single row), not a global window.
    """
    last_full = daily.where(F.col("n_conversations") > 0).agg(F.max("metric_date").alias("_last_full_day"))
    d = daily.crossJoin(F.broadcast(last_full))
    r = daily_ratios(d)
    return d.select(
        "metric_date",
        full_day_name("metric_date").alias("day_of_week"),
        week_start("metric_date").alias("week_start_date"),
        (F.col("metric_date") > F.col("_last_full_day")).alias("is_partial_day"),
        "n_conversations", "n_active_users", "n_auto_resolved", "n_escalated", "n_llm_failure_escalations",
        "n_abandoned",
        r["auto_resolution_rate"].alias("auto_resolution_rate"),
        r["escalation_rate"].alias("escalation_rate"),
        r["llm_failure_escalation_share"].alias("llm_failure_escalation_share"),
        r["abandonment_rate"].alias("abandonment_rate"),
        "n_rated",
        r["avg_satisfaction_score"].alias("avg_satisfaction_score"),
        r["rating_response_rate"].alias("rating_response_rate"),
        "n_requests", "n_requests_in_conversations", "n_orphan_requests",
        r["avg_requests_per_conversation"].alias("avg_requests_per_conversation"),
        "prompt_tokens", "completion_tokens", "total_tokens",
        "n_successful_requests", "n_failed_requests", "n_error_requests", "n_timeout_requests",
        "n_rate_limited_requests",
        r["error_rate"].alias("error_rate"),
        r["timeout_rate"].alias("timeout_rate"),
        r["avg_latency_ms"].alias("avg_latency_ms"),
        "p50_latency_ms", "p95_latency_ms", "p99_latency_ms",
        F.col("cost_usd").alias("total_cost_usd"),
        F.col("logged_cost_usd").alias("total_logged_cost_usd"),
        r["cost_reconciliation_delta_usd"].alias("cost_reconciliation_delta_usd"),
        "n_cost_mismatches",
        r["cost_per_request_usd"].alias("cost_per_request_usd"),
        r["cost_per_conversation_usd"].alias("cost_per_conversation_usd"),
        r["cost_per_auto_resolved_conversation_usd"].alias("cost_per_auto_resolved_conversation_usd"),
        r["cost_per_1k_tokens_usd"].alias("cost_per_1k_tokens_usd"),
        "n_reviewed_predictions", "n_correct_predictions", "n_corrected_predictions",
        r["intent_accuracy"].alias("intent_accuracy"),
        r["corrected_intent_rate"].alias("corrected_intent_rate"),
    )


def fct_daily_model_costs(requests: DataFrame) -> DataFrame:
    """M18 - daily cost ledger per model (orphans included)."""
    failed = F.col("is_failed")
    g = requests.groupBy("request_date", "model_provider", "model_name", "model_tier").agg(
        F.count(F.lit(1)).alias("n_requests"),
        count_where(F.col("is_success")).alias("n_successful_requests"),
        count_where(failed).alias("n_failed_requests"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("cost_usd").alias("total_cost_usd"),
        F.sum("logged_cost_usd").alias("total_logged_cost_usd"),
        count_where(~F.col("is_cost_reconciled")).alias("n_cost_mismatches"),
        sum_where(failed, "cost_usd").alias("wasted_cost_on_failures_usd"),
        # the price is constant per (model, day), so max is the day's price
        F.max("input_price_per_1k_tokens").alias("input_price_per_1k_tokens"),
        F.max("output_price_per_1k_tokens").alias("output_price_per_1k_tokens"),
    )
    return g.select(
        "request_date", "model_provider", "model_name", "model_tier", "n_requests", "n_successful_requests",
        "n_failed_requests", "prompt_tokens", "completion_tokens", "total_tokens", "total_cost_usd",
        "total_logged_cost_usd",
        (F.col("total_cost_usd") - F.col("total_logged_cost_usd")).alias("cost_reconciliation_delta_usd"),
        "n_cost_mismatches",
        ratio("total_cost_usd", "n_requests").alias("cost_per_request_usd"),
        (ratio("total_cost_usd", "total_tokens") * F.lit(1000.0)).alias("cost_per_1k_tokens_usd"),
        "wasted_cost_on_failures_usd", "input_price_per_1k_tokens", "output_price_per_1k_tokens",
    )


def mart_intent_quality(fct_conv: DataFrame, dim_intent: DataFrame) -> DataFrame:
    """M20 - per-intent operations and classifier quality (grouped by routed intent)."""
    c = F.col
    n = F.count(F.lit(1))
    reviewed = count_where(c("intent_is_human_reviewed"))
    per_intent = fct_conv.groupBy(c("initial_intent").alias("intent")).agg(
        n.alias("n_conversations"),
        F.countDistinct("user_id").alias("n_users"),
        count_where(c("is_auto_resolved")).alias("n_auto_resolved"),
        count_where(c("is_escalated")).alias("n_escalated"),
        count_where(c("is_abandoned")).alias("n_abandoned"),
        ratio(count_where(c("is_auto_resolved")), n).alias("auto_resolution_rate"),
        ratio(count_where(c("is_escalated")), n).alias("escalation_rate"),
        F.avg(c("satisfaction_score").cast("double")).alias("avg_satisfaction_score"),
        F.count("satisfaction_score").alias("n_rated"),
        F.avg(c("time_to_handoff_seconds").cast("double")).alias("avg_time_to_handoff_seconds"),
        reviewed.alias("n_reviewed_predictions"),
        count_where(c("intent_is_correct")).alias("n_correct_predictions"),
        count_where(c("intent_is_corrected")).alias("n_corrected_predictions"),
        ratio(count_where(c("intent_is_correct")), reviewed).alias("intent_accuracy"),
        ratio(count_where(c("intent_is_corrected")), reviewed).alias("corrected_intent_rate"),
        ratio(F.sum("intent_confidence"), F.count("intent_confidence")).alias("avg_intent_confidence"),
        ratio(count_where(c("intent_confidence") < F.lit(0.7)), n).alias("low_confidence_share"),
        F.sum("cost_usd").alias("total_cost_usd"),
        ratio(F.sum("cost_usd"), n).alias("cost_per_conversation_usd"),
        ratio(F.sum("cost_usd"), count_where(c("is_auto_resolved"))).alias("cost_per_auto_resolved_usd"),
        F.avg(c("n_requests").cast("double")).alias("avg_requests_per_conversation"),
        # mean of per-conversation means (reference semantics; not an additive ratio)
        F.round(F.avg("avg_latency_ms"), DOUBLE_AVG_SCALE).alias("avg_latency_ms"),
    )
    reasons = (
        fct_conv.where(c("is_escalated") & c("escalation_reason").isNotNull())
        .groupBy("initial_intent", "escalation_reason").agg(n.alias("n"))
        .groupBy(c("initial_intent").alias("intent"))
        .agg(F.min(F.struct((-c("n")).alias("neg_n"), c("escalation_reason").alias("reason"), c("n").alias("n"))).alias("top"))
    )
    i = dim_intent.select("intent", "intent_category", "risk_level", "requires_human_policy")
    j = i.join(per_intent, "intent", "left").join(reasons, "intent", "left")
    metric_cols = [x for x in per_intent.columns if x != "intent"]
    return j.select(
        "intent", "intent_category", "risk_level", "requires_human_policy", *metric_cols,
        c("top.reason").alias("top_escalation_reason"),
        ratio(c("top.n"), "n_escalated").alias("top_escalation_reason_share"),
    )


def mart_model_reliability_daily(requests: DataFrame) -> DataFrame:
    """M21 - reliability per (day, provider, model, tier); percentiles skip NULL latency.

    One hash aggregate of the additive measures; the percentiles are ranks selected
    apart from them, so no measure travels per latency value.
    """
    c = F.col
    st, et, lat = c("status"), c("error_type"), c("latency_ms")
    keys = ["request_date", "model_provider", "model_name", "model_tier"]
    sums = requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_requests"),
        count_where(c("is_failed")).alias("n_failed_requests"),
        count_where(st == "error").alias("n_error_requests"),
        count_where(st == "timeout").alias("n_timeout_requests"),
        count_where(st == "rate_limited").alias("n_rate_limited_requests"),
        count_where(et == "provider_5xx").alias("n_provider_5xx"),
        count_where(et == "content_filter").alias("n_content_filter"),
        count_where(et == "context_length").alias("n_context_length"),
        count_where(et == "invalid_request").alias("n_invalid_request"),
        F.count(lat).alias("n_latency_samples"),
        F.sum(lat).alias("_latency_sum"),
        sum_where(c("is_success"), "completion_tokens").alias("_tokens"),
        count_where(c("is_success") & c("completion_tokens").isNotNull()).alias("_n_tokens"),
        F.sum("cost_usd").alias("total_cost_usd"),
        count_where(c("has_invalid_latency")).alias("n_invalid_latency_rows"),
    )
    g = with_percentiles(sums, requests, keys, "latency_ms", [*LATENCY_PERCENTILES, Percentile("p95_success_latency_ms", 0.95, "is_success")])
    return g.select(
        "request_date", "model_provider", "model_name", "model_tier", "n_requests", "n_failed_requests",
        "n_error_requests", "n_timeout_requests", "n_rate_limited_requests", "n_provider_5xx",
        "n_content_filter", "n_context_length", "n_invalid_request",
        ratio("n_failed_requests", "n_requests").alias("error_rate"), ratio("n_timeout_requests", "n_requests").alias("timeout_rate"),
        "n_latency_samples", ratio("_latency_sum", "n_latency_samples").alias("avg_latency_ms"),
        "p50_latency_ms", "p95_latency_ms", "p99_latency_ms", "p95_success_latency_ms",
        ratio("_tokens", "_n_tokens").alias("avg_completion_tokens"), "total_cost_usd", "n_invalid_latency_rows",
    )
