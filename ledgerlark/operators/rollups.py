"""X03 - re-aggregation of the additive daily components to weeks or months.

The daily mart carries additive components so coarser grains can be built by
summing them and re-deriving every ratio with the same expressions as the
daily mart (never by averaging daily ratios).  Two measures are *not*
additive and are recomputed from the base grain at the coarser period:
distinct active users (from conversations) and latency percentiles (from
requests).  All three inputs aggregate map-side to one row per period before
the (tiny) joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.intermediate import CONVERSATION_SIDE, LATENCY_PERCENTILES, PERCENTILES, REQUEST_SIDE
from ledgerlark.operators.marts import daily_ratios
from ledgerlark.operators.percentiles import with_percentiles

ADDITIVE = [c for c in CONVERSATION_SIDE + REQUEST_SIDE if c != "n_active_users"]
RATIOS = [
    "auto_resolution_rate", "escalation_rate", "llm_failure_escalation_share", "abandonment_rate",
    "avg_satisfaction_score", "rating_response_rate", "avg_requests_per_conversation", "error_rate",
    "timeout_rate", "avg_latency_ms", "cost_per_request_usd", "cost_per_conversation_usd",
    "cost_per_auto_resolved_conversation_usd", "cost_per_1k_tokens_usd", "intent_accuracy", "corrected_intent_rate",
]


def period_start(c, unit: str):
    if unit not in ("week", "month"):
        raise ValueError(unit)
    return F.trunc(F.col(c), unit)


def rollup_kpis(daily: DataFrame, conversations: DataFrame, priced: DataFrame, unit: str) -> DataFrame:
    comps = daily.groupBy(period_start("metric_date", unit).alias("period_start")).agg(
        F.count(F.lit(1)).alias("n_days"), *[F.sum(c).alias(c) for c in ADDITIVE])
    users = conversations.groupBy(period_start("conversation_date", unit).alias("period_start")).agg(
        F.countDistinct("user_id").alias("n_active_users"))
    requests = priced.select(period_start("request_date", unit).alias("period_start"), "latency_ms")
    j = with_percentiles(comps.join(users, "period_start", "left"), requests, ["period_start"], "latency_ms", LATENCY_PERCENTILES)
    r = daily_ratios(j)
    return j.select(
        "period_start", "n_days", *ADDITIVE,
        F.coalesce("n_active_users", F.lit(0)).alias("n_active_users"),
        *PERCENTILES,
        *[r[x].alias(x) for x in RATIOS],
        r["cost_reconciliation_delta_usd"].alias("cost_reconciliation_delta_usd"),
    )
