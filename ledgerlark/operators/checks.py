"""Data-quality operators: generic checks (Q01-Q07), SQL invariants (Q10-Q19),
severity (Q08) and the fused suite runner (Q09).

A check is "a query returning violating rows; zero rows = pass".  Violation
counts follow the usual semantics of each kind: ``unique``, ``accepted_values``
and ``unique_combination_of_columns`` count offending *groups*; the others
count offending *rows*; NULL passes everywhere except ``not_null``.

On the raw text feeds an empty string is a missing value (a text landing zone
cannot tell them apart), so raw-layer checks read blank text as NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources import seeds as SD

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    dataset: str
    kind: str            # unique | not_null | accepted_values | relationships | accepted_range | expression | combination
    column: str | None = None
    values: tuple = ()
    parent: tuple[str, str] | None = None     # (dataset, column) for relationships
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    expression: str | None = None
    columns: tuple[str, ...] = ()
    severity: str = ERROR
    name: str = field(default="")

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        target = self.column or "_".join(self.columns) or ""
        return f"{self.kind}__{self.dataset}__{target}"


def _u(d, c, sev=ERROR):
    return Check(d, "unique", c, severity=sev)


def _nn(d, c, sev=ERROR):
    return Check(d, "not_null", c, severity=sev)


def _av(d, c, values):
    return Check(d, "accepted_values", c, values=tuple(values))


def _rel(d, c, parent, pcol):
    return Check(d, "relationships", c, parent=(parent, pcol))


def _rng(d, c, low=None, high=None, inclusive=True):
    return Check(d, "accepted_range", c, low=low, high=high, inclusive=inclusive)


def _ex(d, name, expr, sev=ERROR):
    return Check(d, "expression", expression=expr, severity=sev, name=f"expression__{d}__{name}")


def _combo(d, *cols):
    return Check(d, "combination", columns=tuple(cols))


# ---------------------------------------------------------------------------
# Declared checks of the reference warehouse (160), dataset by dataset.
# ---------------------------------------------------------------------------
DECLARED: list[Check] = [
    _u("raw_users", "user_id"), _nn("raw_users", "user_id"),
    _u("raw_conversations", "conversation_id"), _nn("raw_conversations", "conversation_id"),
    _nn("raw_conversations", "user_id"), _rel("raw_conversations", "user_id", "raw_users", "user_id"),
    _nn("raw_llm_requests", "request_id"), _nn("raw_llm_requests", "conversation_id", WARN),
    _u("raw_llm_requests", "request_id", WARN),
    _ex("raw_llm_requests", "latency_non_negative", "cast(nullif(trim(latency_ms), '') as bigint) >= 0", WARN),
    _ex("raw_llm_requests", "token_sum",
        "cast(nullif(trim(total_tokens), '') as bigint) = cast(nullif(trim(prompt_tokens), '') as bigint)"
        " + cast(nullif(trim(completion_tokens), '') as bigint)", WARN),
    _u("raw_intent_predictions", "prediction_id"), _nn("raw_intent_predictions", "prediction_id"),
    _u("raw_escalations", "escalation_id"), _nn("raw_escalations", "escalation_id"),
    _combo("raw_daily_model_prices", "price_date", "model_provider", "model_name"),
    # seeds
    _u("model_aliases", "model_name_alias"), _nn("model_aliases", "model_name_alias"),
    _nn("model_aliases", "model_name_canonical"),
    _u("intent_catalog", "intent"), _nn("intent_catalog", "intent"),
    _av("intent_catalog", "risk_level", ["low", "medium", "high"]),
    _u("model_catalog", "model_name"), _nn("model_catalog", "model_name"),
    _av("model_catalog", "model_tier", ["fast", "strong"]),
    # staging
    _u("stg_users", "user_id"), _nn("stg_users", "user_id"), _nn("stg_users", "created_at"),
    _av("stg_users", "segment", SD.SEGMENTS), _av("stg_users", "signup_channel", SD.SIGNUP_CHANNELS),
    _ex("stg_conversations", "not_resolved_and_escalated", "not (is_auto_resolved and is_escalated)"),
    _u("stg_conversations", "conversation_id"), _nn("stg_conversations", "conversation_id"),
    _nn("stg_conversations", "user_id"), _nn("stg_conversations", "resolution_status"),
    _rel("stg_conversations", "user_id", "stg_users", "user_id"),
    _av("stg_conversations", "channel", SD.CHANNELS),
    _av("stg_conversations", "resolution_status", SD.RESOLUTION_STATUSES),
    _av("stg_conversations", "satisfaction_score", [1, 2, 3, 4, 5]),
    _rng("stg_conversations", "duration_seconds", 0),
    _ex("stg_llm_requests", "token_sum", "total_tokens = prompt_tokens + completion_tokens"),
    _ex("stg_llm_requests", "error_type_matches_status",
        "(is_failed and error_type is not null) or (is_success and error_type is null)"),
    _u("stg_llm_requests", "request_id"), _nn("stg_llm_requests", "request_id"),
    _nn("stg_llm_requests", "model_name"),
    _rel("stg_llm_requests", "conversation_id", "stg_conversations", "conversation_id"),
    _rel("stg_llm_requests", "model_name", "stg_daily_model_prices", "model_name"),
    _av("stg_llm_requests", "model_provider", SD.PROVIDERS),
    _av("stg_llm_requests", "status", SD.REQUEST_STATUSES),
    _rng("stg_llm_requests", "prompt_tokens", 0), _rng("stg_llm_requests", "completion_tokens", 0),
    _rng("stg_llm_requests", "latency_ms", 0), _rng("stg_llm_requests", "recorded_cost_usd", 0),
    _u("stg_intent_predictions", "prediction_id"), _nn("stg_intent_predictions", "prediction_id"),
    _nn("stg_intent_predictions", "conversation_id"),
    _rel("stg_intent_predictions", "conversation_id", "stg_conversations", "conversation_id"),
    _rng("stg_intent_predictions", "confidence", 0, 1),
    _u("stg_escalations", "escalation_id"), _u("stg_escalations", "conversation_id"),
    _nn("stg_escalations", "escalation_id"), _nn("stg_escalations", "conversation_id"),
    _rel("stg_escalations", "conversation_id", "stg_conversations", "conversation_id"),
    _av("stg_escalations", "escalation_reason", SD.ESCALATION_REASONS),
    _av("stg_escalations", "handled_by_team", SD.TEAMS),
    _rng("stg_escalations", "time_to_handoff_seconds", 0),
    _combo("stg_daily_model_prices", "price_date", "model_provider", "model_name"),
    _rng("stg_daily_model_prices", "input_price_per_1k_tokens", 0, inclusive=False),
    _rng("stg_daily_model_prices", "output_price_per_1k_tokens", 0, inclusive=False),
    # intermediate
    _u("int_model_costs", "request_id"), _nn("int_model_costs", "request_id"),
    _nn("int_model_costs", "calculated_cost_usd"), _rng("int_model_costs", "calculated_cost_usd", 0),
    _av("int_model_costs", "is_missing_price", [False]),
    _ex("int_conversation_request_rollup", "outcomes_add_up",
        "n_successful_requests + n_failed_requests = n_requests"),
    _ex("int_conversation_request_rollup", "first_before_last", "first_request_at <= last_request_at"),
    _u("int_conversation_request_rollup", "conversation_id"),
    _nn("int_conversation_request_rollup", "conversation_id"),
    _rel("int_conversation_request_rollup", "conversation_id", "stg_conversations", "conversation_id"),
    _rng("int_conversation_request_rollup", "n_requests", 1),
    _u("int_conversation_quality", "conversation_id"), _nn("int_conversation_quality", "conversation_id"),
    _av("int_conversation_quality", "is_escalated_without_record", [False]),
    _av("int_conversation_quality", "has_record_without_escalation_flag", [False]),
    _ex("int_daily_product_metrics", "resolution_mix_adds_up",
        "n_auto_resolved + n_escalated + n_abandoned = n_conversations"),
    _ex("int_daily_product_metrics", "outcomes_add_up", "n_successful_requests + n_failed_requests = n_requests"),
    _ex("int_daily_product_metrics", "active_users_bounded", "n_active_users <= n_conversations"),
    _u("int_daily_product_metrics", "metric_date"), _nn("int_daily_product_metrics", "metric_date"),
    _combo("int_intent_confusion", "actual_intent", "predicted_intent"),
    _rng("int_intent_confusion", "share_of_actual", 0, 1),
    # marts
    _u("dim_users", "user_id"), _nn("dim_users", "user_id"), _av("dim_users", "segment", SD.SEGMENTS),
    _rng("dim_users", "lifetime_llm_cost_usd", 0), _rng("dim_users", "days_to_first_conversation", 0),
    _u("dim_models", "model_name"), _nn("dim_models", "model_name"),
    _nn("dim_models", "current_input_price_per_1k_tokens"), _av("dim_models", "model_provider", SD.PROVIDERS),
    _u("dim_intents", "intent"), _nn("dim_intents", "intent"), _rng("dim_intents", "n_conversations", 1),
    _ex("fct_conversations", "not_resolved_and_escalated", "not (is_auto_resolved and is_escalated)"),
    _ex("fct_conversations", "reason_iff_escalated",
        "(is_escalated and escalation_reason is not null) or (not is_escalated and escalation_reason is null)"),
    _u("fct_conversations", "conversation_id"), _nn("fct_conversations", "conversation_id"),
    _nn("fct_conversations", "user_id"), _rel("fct_conversations", "user_id", "dim_users", "user_id"),
    _rel("fct_conversations", "initial_intent", "dim_intents", "intent"),
    _av("fct_conversations", "resolution_status", SD.RESOLUTION_STATUSES),
    _rng("fct_conversations", "cost_usd", 0),
    _u("fct_llm_requests", "request_id"), _nn("fct_llm_requests", "request_id"),
    _nn("fct_llm_requests", "model_name"), _nn("fct_llm_requests", "cost_usd"),
    _rel("fct_llm_requests", "conversation_id", "fct_conversations", "conversation_id"),
    _rel("fct_llm_requests", "model_name", "dim_models", "model_name"),
    _rng("fct_llm_requests", "cost_usd", 0), _rng("fct_llm_requests", "latency_ms", 0),
    _ex("fct_daily_product_metrics", "resolution_rates_sum_to_one",
        "auto_resolution_rate + escalation_rate + abandonment_rate between 0.999 and 1.001"),
    _ex("fct_daily_product_metrics", "p95_at_least_mean", "p95_latency_ms >= avg_latency_ms"),
    _ex("fct_daily_product_metrics", "percentiles_ordered",
        "p99_latency_ms >= p95_latency_ms and p95_latency_ms >= p50_latency_ms"),
    _u("fct_daily_product_metrics", "metric_date"), _nn("fct_daily_product_metrics", "metric_date"),
    _rng("fct_daily_product_metrics", "auto_resolution_rate", 0, 1),
    _rng("fct_daily_product_metrics", "escalation_rate", 0, 1),
    _rng("fct_daily_product_metrics", "error_rate", 0, 1),
    _rng("fct_daily_product_metrics", "intent_accuracy", 0, 1),
    _rng("fct_daily_product_metrics", "avg_satisfaction_score", 1, 5),
    _rng("fct_daily_product_metrics", "total_cost_usd", 0),
    _combo("fct_daily_model_costs", "request_date", "model_provider", "model_name"),
    _rel("fct_daily_model_costs", "model_name", "dim_models", "model_name"),
    _rng("fct_daily_model_costs", "total_cost_usd", 0),
    _combo("mart_model_reliability_daily", "request_date", "model_provider", "model_name"),
    _ex("mart_model_reliability_daily", "failures_add_up",
        "n_error_requests + n_timeout_requests + n_rate_limited_requests = n_failed_requests"),
    _ex("mart_model_reliability_daily", "p95_at_least_mean", "p95_latency_ms >= avg_latency_ms"),
    _rng("mart_model_reliability_daily", "error_rate", 0, 1),
    _u("mart_intent_quality", "intent"), _nn("mart_intent_quality", "intent"),
    _rng("mart_intent_quality", "auto_resolution_rate", 0, 1),
    _rng("mart_intent_quality", "escalation_rate", 0, 1),
    _rng("mart_intent_quality", "intent_accuracy", 0, 1),
    _rng("mart_intent_quality", "corrected_intent_rate", 0, 1),
    _combo("mart_daily_anomalies", "metric_date", "metric_name"),
    _ex("mart_daily_anomalies", "anomaly_has_z", "not is_anomaly or robust_z is not null"),
    _ex("mart_daily_anomalies", "actionable_is_anomaly", "not is_actionable_anomaly or is_anomaly"),
    _nn("mart_daily_anomalies", "metric_name"),
    _av("mart_daily_anomalies", "metric_kind", ["proportion", "score", "ratio", "count", "amount"]),
    _av("mart_daily_anomalies", "direction", ["high", "low"]),
    _rng("mart_daily_anomalies", "baseline_spread", 0, inclusive=False),
    _combo("fct_weekly_cohort_retention", "signup_week", "weeks_since_signup"),
    _ex("fct_weekly_cohort_retention", "retained_within_cohort", "n_retained_users <= cohort_size"),
    _ex("fct_weekly_cohort_retention", "conversations_cover_retained", "n_conversations >= n_retained_users"),
    _ex("fct_weekly_cohort_retention", "escalated_within_conversations",
        "n_escalated_conversations <= n_conversations"),
    _rng("fct_weekly_cohort_retention", "cohort_size", 1),
    _rng("fct_weekly_cohort_retention", "weeks_since_signup", 0),
    _rng("fct_weekly_cohort_retention", "retention_rate", 0, 1),
    _nn("fct_weekly_cohort_retention", "retention_rate"),
    _nn("fct_weekly_cohort_retention", "is_fully_observable"),
]
# ---------------------------------------------------------------------------

RAW_DATASETS = {"raw_users", "raw_conversations", "raw_llm_requests", "raw_intent_predictions",
                "raw_escalations", "raw_daily_model_prices"}
ROW_KINDS = ("not_null", "accepted_range", "expression")


def layer_of(dataset: str) -> str:
    if dataset in RAW_DATASETS:
        return "source"
    if dataset in ("model_aliases", "intent_catalog", "model_catalog"):
        return "seed"
    return {"stg": "staging", "int": "intermediate"}.get(dataset.split("_")[0], "mart")


def _value(df: DataFrame, dataset: str, column: str) -> Column:
    c = F.col(column)
    if dataset in RAW_DATASETS:
        t = F.trim(c)
        return F.when(t != F.lit(""), c)
    return c


def row_violation(check: Check, df: DataFrame) -> Column:
    """Boolean column that is TRUE exactly on the rows violating a row-level check."""
    if check.kind == "not_null":
        return _value(df, check.dataset, check.column).isNull()
    if check.kind == "accepted_range":
        c = F.col(check.column)
        ok = F.lit(True)
        if check.low is not None:
            ok = ok & ((c >= F.lit(check.low)) if check.inclusive else (c > F.lit(check.low)))
        if check.high is not None:
            ok = ok & ((c <= F.lit(check.high)) if check.inclusive else (c < F.lit(check.high)))
        return F.coalesce(~ok, F.lit(False))
    if check.kind == "expression":
        return F.coalesce(~F.expr(check.expression), F.lit(False))
    raise ValueError(check.kind)


def unique_violations(df: DataFrame, dataset: str, column: str) -> DataFrame:
    v = _value(df, dataset, column)
    return df.where(v.isNotNull()).groupBy(v.alias(column)).agg(F.count(F.lit(1)).alias("n_records")) \
        .where(F.col("n_records") > 1)


def combination_violations(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values_violations(df: DataFrame, column: str, values: tuple) -> DataFrame:
    c = F.col(column)
    return df.where(~c.isin(*values)).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent row and the rows that hold them.

    The keys are counted first (combined map-side), so the anti join sees each key
    once: a handful for a catalogue key, and a hot key is one row per task.
    """
    keys = parent.select(F.col(parent_column).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    c = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return c.join(keys, c[column] == keys["_parent_key"], "left_anti")


GROUPED_KINDS = ("unique", "combination", "accepted_values")


def grouped_violation_counts(df: DataFrame, dataset: str, checks: list[Check]) -> DataFrame:
    """All unique / combination / accepted-values checks of one dataset - and, fused in
    the same pass, its row-level checks - in ONE scan and ONE shuffle.

    Each row emits one (check, key) entry per check that concerns it: the key for
    unique / combination checks, only offending values for accepted-values checks,
    and a NULL key when it violates a row-level check.  A single ``groupBy(check, key)``
    counts the groups; its partial aggregate folds the row-level entries map-side into
    one count per check and task, so they add almost nothing to the shuffle.
    """
    entries = []
    for i, c in enumerate(checks):
        if c.kind == "unique":
            v = _value(df, dataset, c.column)
            entries.append(F.when(v.isNotNull(), F.struct(F.lit(i).alias("i"), v.cast("string").alias("k"))))
        elif c.kind == "combination":
            key = F.to_json(F.struct(*[F.col(x) for x in c.columns]), {"ignoreNullFields": "false"})
            entries.append(F.struct(F.lit(i).alias("i"), key.alias("k")))
        elif c.kind == "accepted_values":
            bad = ~F.col(c.column).isin(*c.values)
            entries.append(F.when(bad, F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("k"))))
        else:
            entries.append(F.when(row_violation(c, df),
                                  F.struct(F.lit(i).alias("i"), F.lit(None).cast("string").alias("k"))))
    exploded = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
    groups = exploded.groupBy("e.i", "e.k").agg(F.count(F.lit(1)).alias("n"))
    # One global aggregate over the (few) offending groups counts every check at once,
    # zeros included: no second shuffle on the check id and no join with a list of ids.
    i, n = F.col("i"), F.col("n")

    def count(j: int, c: Check) -> Column:
        if c.kind in ROW_KINDS:          # offending rows: the size of the check's one group
            return F.coalesce(F.sum(F.when(i == F.lit(j), n)), F.lit(0))
        offending = (n > 1) if c.kind != "accepted_values" else F.lit(True)
        return F.count_if((i == F.lit(j)) & offending)

    counts = groups.agg(*[count(j, c).alias(f"c{j}") for j, c in enumerate(checks)])
    return counts.select(F.inline(F.array(*[F.struct(*_result(c, F.col(f"c{j}"))) for j, c in enumerate(checks)])))


def _result(check: Check, n: Column) -> list[Column]:
    return [
        F.lit(check.check_name).alias("check_name"),
        F.lit(check.dataset).alias("dataset"),
        F.lit(layer_of(check.dataset)).alias("layer"),
        F.lit(check.kind).alias("kind"),
        F.lit(check.severity).alias("severity"),
        n.cast("long").alias("n_violations"),
    ]


def run_checks(datasets: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Q09 - one row per check: (check_name, dataset, layer, kind, severity, n_violations, status).

    All row-level and grouped kinds (unique / combination / accepted values) of
    one dataset share one scan and one shuffle (a dataset with row-level checks
    only takes a single ``count_if`` aggregate pass), so N checks on a table cost
    one scan, not N; each relationship check is one anti join.
    """
    parts: list[DataFrame] = []
    by_dataset: dict[str, list[Check]] = {}
    for ch in checks:
        by_dataset.setdefault(ch.dataset, []).append(ch)
    for name, group in by_dataset.items():
        df = datasets[name]
        row_checks = [c for c in group if c.kind in ROW_KINDS]
        grouped = [c for c in group if c.kind in GROUPED_KINDS]
        if grouped:
            # row-level checks ride along in the grouped pass: one scan of the dataset
            parts.append(grouped_violation_counts(df, name, grouped + row_checks))
        elif row_checks:
            counts = df.agg(*[F.count_if(row_violation(c, df)).alias(f"c{i}") for i, c in enumerate(row_checks)])
            parts.append(counts.select(F.inline(F.array(*[
                F.struct(*_result(c, F.col(f"c{i}"))) for i, c in enumerate(row_checks)
            ]))))
        for c in group:
            if c.kind != "relationships":
                continue
            v = relationship_violations(df, c.column, datasets[c.parent[0]], c.parent[1])
            parts.append(v.agg(*_result(c, F.coalesce(F.sum("n_records"), F.lit(0)))))
    out = reduce(DataFrame.unionByName, parts)
    return with_status(out)


def with_status(results: DataFrame) -> DataFrame:
    n, sev = F.col("n_violations"), F.col("severity")
    return results.withColumn(
        "status", F.when(n == 0, "pass").when(sev == WARN, "warn").otherwise("error")
    )
