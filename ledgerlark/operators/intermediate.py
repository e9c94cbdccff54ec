"""Intermediate datasets M07-M11.

Physical choices (SURVEY §4):

* ``int_model_costs`` (M07) keeps one row per request and carries the staging
  columns, so every downstream consumer reads one "priced requests" dataset
  instead of re-joining requests to their own cost view on request_id (J05).
* The price sheet is joined without a hint: the planner broadcasts it while its
  known size is small and sort-merges beyond, AQE decides again at run time.
* Conversation-grain results are all hash-partitioned on conversation_id, so
  the joins that assemble the conversation facts reuse one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import count_where, ratio
from ledgerlark.operators.percentiles import Percentile, with_percentiles

COST_TOLERANCE_REL = "0.005"
COST_TOLERANCE_ABS = "0.00001"


def calculated_cost(prompt_tokens, completion_tokens, input_price, output_price):
    """Exact-decimal cost of a request, rounded half-up to 6 places."""
    raw = prompt_tokens * input_price + completion_tokens * output_price
    return (raw * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(12,6)")


def price_of_day(requests: DataFrame, prices: DataFrame) -> DataFrame:
    """X04 - attach the price sheet row valid on each request's date (exact (model, date) key)."""
    p = prices.select(
        F.col("model_name").alias("_p_model"),
        F.col("price_date").alias("_p_date"),
        "input_price_per_1k_tokens",
        "output_price_per_1k_tokens",
    )
    return requests.join(
        p, (requests.model_name == p._p_model) & (requests.request_date == p._p_date), "left"
    ).drop("_p_model", "_p_date")


def int_model_costs(requests: DataFrame, prices: DataFrame) -> DataFrame:
    """M07 - request-grain cost recomputation and reconciliation.

    Returns the full staging row plus price, recomputed cost and reconciliation
    columns.  ``model_costs_view`` projects the published M07 contract.
    """
    j = price_of_day(requests, prices)
    calc = calculated_cost(
        F.col("prompt_tokens"), F.col("completion_tokens"),
        F.col("input_price_per_1k_tokens"), F.col("output_price_per_1k_tokens"),
    )
    j = j.withColumn("calculated_cost_usd", calc)
    delta = F.col("recorded_cost_usd") - F.col("calculated_cost_usd")
    tol = F.greatest(
        F.lit(COST_TOLERANCE_REL).cast("decimal(4,3)") * F.col("calculated_cost_usd"),
        F.lit(COST_TOLERANCE_ABS).cast("decimal(6,5)"),
    )
    return j.withColumns({
        "is_missing_price": F.col("input_price_per_1k_tokens").isNull(),
        "cost_delta_usd": delta,
        "cost_delta_pct": F.when(F.col("calculated_cost_usd") > 0, ratio(delta, "calculated_cost_usd")),
        "is_cost_reconciled": F.abs(delta) <= tol,
    })


MODEL_COSTS_COLUMNS = [
    "request_id", "conversation_id", "request_date", "model_provider", "model_name", "prompt_tokens",
    "completion_tokens", "total_tokens", "recorded_cost_usd", "input_price_per_1k_tokens",
    "output_price_per_1k_tokens", "calculated_cost_usd", "is_missing_price", "cost_delta_usd",
    "cost_delta_pct", "is_cost_reconciled",
]


def model_costs_view(priced: DataFrame) -> DataFrame:
    return priced.select(*MODEL_COSTS_COLUMNS)


def int_conversation_request_rollup(priced: DataFrame) -> DataFrame:
    """M08 - conversation-grain request aggregates; orphans excluded.

    One aggregate pass that combines map-side, so one shuffle of at most a row per
    conversation and task.  First and last model are those of the least and greatest
    (created_at, request_id); a request without time or model is neither.  The sets
    behind the distinct counts are bounded by the catalogue and avoid the row-multiplying
    Expand of several ``count(distinct)``.
    """
    r = priced.where(F.col("conversation_id").isNotNull())
    st = F.col("status")
    place = F.when(F.col("created_at").isNotNull() & F.col("model_name").isNotNull(), F.struct("created_at", "request_id"))
    issue = F.col("has_invalid_latency") | F.col("has_token_sum_mismatch") | F.col("has_model_alias") | F.col("had_duplicate_ingest")
    rolled = r.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("n_requests"),
        count_where(F.col("is_success")).alias("n_successful_requests"),
        count_where(F.col("is_failed")).alias("n_failed_requests"),
        count_where(st == "error").alias("n_error_requests"),
        count_where(st == "timeout").alias("n_timeout_requests"),
        count_where(st == "rate_limited").alias("n_rate_limited_requests"),
        F.size(F.collect_set("model_name")).cast("long").alias("n_distinct_models"),
        F.size(F.collect_set("model_provider")).cast("long").alias("n_distinct_providers"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("calculated_cost_usd").alias("cost_usd"),
        F.sum("recorded_cost_usd").alias("logged_cost_usd"),
        F.count("latency_ms").alias("_n_latency"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.sum("latency_ms").alias("total_latency_ms"),
        F.bool_or("is_failed").alias("had_failed_request"),
        F.bool_or(issue).alias("had_data_quality_issue"),
        F.min("created_at").alias("first_request_at"),
        F.max("created_at").alias("last_request_at"),
        F.min_by("model_name", place).alias("first_model_name"),
        F.max_by("model_name", place).alias("last_model_name"),
    )
    return rolled.select(
        "conversation_id", "n_requests", "n_successful_requests", "n_failed_requests", "n_error_requests", "n_timeout_requests",
        "n_rate_limited_requests", "n_distinct_models", "n_distinct_providers", "prompt_tokens", "completion_tokens", "total_tokens",
        "cost_usd", "logged_cost_usd", ratio("total_latency_ms", "_n_latency").alias("avg_latency_ms"), "max_latency_ms", "total_latency_ms",
        "had_failed_request", "had_data_quality_issue", "first_request_at", "last_request_at", "first_model_name", "last_model_name",
    )


def first_prediction(predictions: DataFrame) -> DataFrame:
    """W02/W03 - earliest prediction per conversation plus the prediction count.

    A map-side-combining aggregate (``min`` of a struct led by predicted_at)
    instead of a ``row_number`` window: skew-proof and one exchange.
    """
    payload = [c for c in predictions.columns if c not in ("conversation_id", "predicted_at", "prediction_id")]
    first = predictions.groupBy("conversation_id").agg(
        F.min(F.struct(
            F.col("predicted_at").isNull().alias("_null"), "predicted_at", "prediction_id", *payload
        )).alias("_p"),
        F.count(F.lit(1)).alias("n_predictions"),
    )
    return first.select(
        "conversation_id", "_p.prediction_id", "_p.predicted_at",
        *[F.col(f"_p.{c}").alias(c) for c in payload], "n_predictions",
    )


def int_conversation_quality(conversations: DataFrame, predictions: DataFrame, escalations: DataFrame) -> DataFrame:
    """M09 - classifier and hand-off signals per conversation."""
    c = conversations.select(
        "conversation_id", "initial_intent", "resolution_status", "is_escalated", "is_auto_resolved",
        "has_conflicting_resolution", "satisfaction_score", "has_satisfaction_score",
    )
    p = first_prediction(predictions).select(
        "conversation_id", "prediction_id", "predicted_intent", "confidence", "confidence_bucket",
        "human_corrected_intent", "is_human_reviewed", "is_correct", "is_corrected", "n_predictions",
    )
    e = escalations.select(
        "conversation_id", "escalation_id", "escalated_at", "escalation_reason", "handled_by_team",
        "time_to_handoff_seconds",
    )
    j = c.join(p, "conversation_id", "left").join(e, "conversation_id", "left")
    return j.select(
        "conversation_id", "initial_intent", "resolution_status", "is_escalated", "is_auto_resolved",
        "has_conflicting_resolution", "satisfaction_score", "has_satisfaction_score",
        "prediction_id", "predicted_intent", "confidence", "confidence_bucket", "human_corrected_intent",
        "is_human_reviewed", "is_correct", "is_corrected", "n_predictions",
        (F.col("predicted_intent") == F.col("initial_intent")).alias("prediction_matches_initial_intent"),
        "escalation_id", "escalated_at", "escalation_reason", "handled_by_team", "time_to_handoff_seconds",
        (F.col("is_escalated") & F.col("escalation_id").isNull()).alias("is_escalated_without_record"),
        (~F.col("is_escalated") & F.col("escalation_id").isNotNull()).alias("has_record_without_escalation_flag"),
    )


CONVERSATION_SIDE = [
    "n_conversations", "n_active_users", "n_auto_resolved", "n_escalated", "n_llm_failure_escalations",
    "n_abandoned", "n_rated", "satisfaction_score_sum", "n_reviewed_predictions", "n_correct_predictions",
    "n_corrected_predictions", "n_requests_in_conversations", "conversation_cost_usd",
]
REQUEST_SIDE = [
    "n_requests", "n_successful_requests", "n_failed_requests", "n_error_requests", "n_timeout_requests",
    "n_rate_limited_requests", "n_orphan_requests", "prompt_tokens", "completion_tokens", "total_tokens",
    "cost_usd", "logged_cost_usd", "n_cost_mismatches", "n_latency_samples", "latency_ms_sum",
]
PERCENTILES = ["p50_latency_ms", "p95_latency_ms", "p99_latency_ms"]
LATENCY_PERCENTILES = [Percentile(n, p) for n, p in zip(PERCENTILES, (0.5, 0.95, 0.99), strict=True)]


def conversation_day_components(conv_facts: DataFrame, date_col: str = "conversation_date") -> DataFrame:
    """Additive conversation-side components grouped by ``date_col``.

    ``conv_facts`` is the conversation grain joined with quality and rollup
    columns (n_requests / cost_usd NULL when a conversation has no request).
    """
    return conv_facts.groupBy(F.col(date_col).alias("metric_date")).agg(
        F.count(F.lit(1)).alias("n_conversations"),
        F.countDistinct("user_id").alias("n_active_users"),
        count_where(F.col("is_auto_resolved")).alias("n_auto_resolved"),
        count_where(F.col("is_escalated")).alias("n_escalated"),
        count_where(F.col("escalation_reason") == "llm_failure").alias("n_llm_failure_escalations"),
        count_where(F.col("resolution_status") == "abandoned").alias("n_abandoned"),
        count_where(F.col("has_satisfaction_score")).alias("n_rated"),
        F.sum("satisfaction_score").alias("satisfaction_score_sum"),
        count_where(F.col("is_human_reviewed")).alias("n_reviewed_predictions"),
        count_where(F.col("is_correct")).alias("n_correct_predictions"),
        count_where(F.col("is_corrected")).alias("n_corrected_predictions"),
        F.sum("rollup_n_requests").alias("n_requests_in_conversations"),
        F.sum("rollup_cost_usd").alias("conversation_cost_usd"),
    )


def request_day_components(priced: DataFrame, date_col: str = "request_date") -> DataFrame:
    """Additive request-side components plus exact latency percentiles by ``date_col``.

    One hash aggregate of the additive measures, which combines a hot day map-side; the
    percentiles are ranks selected apart from them (``operators.percentiles``).
    """
    st, lat, day = F.col("status"), F.col("latency_ms"), priced.withColumn("metric_date", F.col(date_col))
    sums = day.groupBy("metric_date").agg(
        F.count(F.lit(1)).alias("n_requests"),
        count_where(F.col("is_success")).alias("n_successful_requests"),
        count_where(F.col("is_failed")).alias("n_failed_requests"),
        count_where(st == "error").alias("n_error_requests"),
        count_where(st == "timeout").alias("n_timeout_requests"),
        count_where(st == "rate_limited").alias("n_rate_limited_requests"),
        count_where(F.col("is_orphan")).alias("n_orphan_requests"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("calculated_cost_usd").alias("cost_usd"),
        F.sum("recorded_cost_usd").alias("logged_cost_usd"),
        count_where(~F.col("is_cost_reconciled")).alias("n_cost_mismatches"),
        F.count(lat).alias("n_latency_samples"),
        F.sum(lat).alias("latency_ms_sum"),
    )
    return with_percentiles(sums, day, ["metric_date"], "latency_ms", LATENCY_PERCENTILES)


def calendar(conversations: DataFrame, requests: DataFrame) -> DataFrame:
    """Day spine between the earliest and latest conversation or request date.

    Bounds come from one 1-row aggregate over the union of both date columns;
    the spine is generated with ``explode(sequence)`` - no driver round trip.
    """
    dates = conversations.select(F.col("conversation_date").alias("d")).unionByName(
        requests.select(F.col("request_date").alias("d"))
    )
    bounds = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("metric_date"))


def int_daily_product_metrics(conv_facts: DataFrame, priced: DataFrame, conversations: DataFrame) -> DataFrame:
    """M10 - one row per calendar day of additive components (zero filled)."""
    cal = calendar(conversations, priced)
    cs = conversation_day_components(conv_facts)
    rs = request_day_components(priced)
    j = cal.join(cs, "metric_date", "left").join(rs, "metric_date", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in CONVERSATION_SIDE + REQUEST_SIDE}
    out = j.select("metric_date", *[zero[c].alias(c) for c in CONVERSATION_SIDE + REQUEST_SIDE], *PERCENTILES)
    return out


def int_intent_confusion(predictions: DataFrame) -> DataFrame:
    """M11 - confusion matrix on the human-reviewed subset.

    Pair counts and the row totals come from one aggregate plus a window sum
    over the (tiny) aggregated pairs - no self-join of the predictions.
    """
    reviewed = predictions.where(F.col("is_human_reviewed"))
    pairs = reviewed.groupBy(
        F.col("human_corrected_intent").alias("actual_intent"), "predicted_intent"
    ).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.sum("confidence").alias("_conf_sum"),
        F.count("confidence").alias("_conf_n"),
    )
    n_actual = F.sum("n_predictions").over(Window.partitionBy("actual_intent"))
    return pairs.select(
        "actual_intent",
        "predicted_intent",
        (F.col("actual_intent") == F.col("predicted_intent")).alias("is_correct"),
        "n_predictions",
        n_actual.alias("n_actual"),
        ratio("n_predictions", n_actual).alias("share_of_actual"),
        ratio("_conf_sum", "_conf_n").alias("avg_confidence"),
    )
