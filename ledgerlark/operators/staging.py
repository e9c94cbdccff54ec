"""Staging datasets M01-M06: typed, cleaned, one row per business key.

Rule: *flag, don't drop*.  Every defect in a feed becomes a boolean column; the
only rows removed are the later copies of replayed requests (M03).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import (
    blank_to_null,
    lower_trim,
    minute_boundaries_between,
    round_half_up_int,
    seconds_between,
    text_cast,
    week_start,
)


def stg_users(raw: DataFrame) -> DataFrame:
    """M01 - one row per user; ``signup_week`` is the Monday of the signup date."""
    created = text_cast("created_at", "timestamp")
    return raw.select(
        F.col("user_id"),
        created.alias("created_at"),
        created.cast("date").alias("signup_date"),
        week_start(created.cast("date")).alias("signup_week"),
        F.upper(F.trim("country")).alias("country_code"),
        lower_trim("segment").alias("segment"),
        lower_trim("signup_channel").alias("signup_channel"),
    )


def stg_conversations(raw: DataFrame) -> DataFrame:
    """M02 - escalation wins over "resolved"; the contradiction is flagged."""
    typed = raw.select(
        F.col("conversation_id"),
        F.col("user_id"),
        text_cast("started_at", "timestamp").alias("started_at"),
        text_cast("ended_at", "timestamp").alias("ended_at"),
        lower_trim("channel").alias("channel"),
        lower_trim("initial_intent").alias("initial_intent"),
        text_cast("resolved_without_escalation", "boolean").alias("raw_resolved"),
        text_cast("escalated", "boolean").alias("raw_escalated"),
        text_cast("satisfaction_score", "decimal(3,1)").alias("score"),
    )
    resolved, escalated = F.col("raw_resolved"), F.col("raw_escalated")
    return typed.select(
        "conversation_id",
        "user_id",
        "started_at",
        "ended_at",
        F.col("started_at").cast("date").alias("conversation_date"),
        seconds_between("started_at", "ended_at").alias("duration_seconds"),
        "channel",
        "initial_intent",
        escalated.alias("is_escalated"),
        (resolved & ~escalated).alias("is_auto_resolved"),
        F.when(escalated, "escalated").when(resolved, "auto_resolved").otherwise("abandoned")
        .alias("resolution_status"),
        (resolved & escalated).alias("has_conflicting_resolution"),
        round_half_up_int("score").alias("satisfaction_score"),
        F.col("score").isNotNull().alias("has_satisfaction_score"),
    )


def _typed_requests(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("request_id"),
        blank_to_null("conversation_id").alias("conversation_id"),
        text_cast("created_at", "timestamp").alias("created_at"),
        text_cast("_ingested_at", "timestamp").alias("ingested_at"),
        lower_trim("model_provider").alias("model_provider"),
        F.trim("model_name").alias("model_name_raw"),
        text_cast("prompt_tokens", "int").alias("prompt_tokens"),
        text_cast("completion_tokens", "int").alias("completion_tokens"),
        text_cast("total_tokens", "int").alias("raw_total_tokens"),
        text_cast("latency_ms", "int").alias("raw_latency_ms"),
        text_cast("cost_usd", "decimal(12,6)").alias("recorded_cost_usd"),
        lower_trim("status").alias("status"),
        blank_to_null(F.lower("error_type")).alias("error_type"),
    )


def earliest_copies(typed: DataFrame) -> DataFrame:
    """W01/W02 - the earliest-ingested copy of each request_id and the number of copies.

    One aggregate: ``min`` over a struct whose leading fields are (ingested_at,
    created_at) picks the earliest copy, the remaining fields make ties deterministic.
    Unlike a ``row_number`` window it combines map-side, so a request_id replayed
    millions of times never lands whole in a single task.  It sorts, though: for rows
    of which few are copies see ``dedupe_requests``.
    """
    merged = "ingest_copies" in typed.columns       # already-deduplicated rows carry their copy count
    payload = [c for c in typed.columns if c not in ("request_id", "ingested_at", "created_at", "ingest_copies")]
    order = F.struct(
        F.col("ingested_at").isNull().alias("_ing_null"),
        F.col("ingested_at"),
        F.col("created_at").isNull().alias("_cr_null"),
        F.col("created_at"),
        *[F.col(c) for c in payload],
    )
    first = typed.groupBy("request_id").agg(
        F.min(order).alias("_first"),
        (F.sum("ingest_copies") if merged else F.count(F.lit(1))).alias("ingest_copies"),
    )
    return first.select(
        "request_id",
        "_first.ingested_at",
        "_first.created_at",
        *[F.col(f"_first.{c}").alias(c) for c in payload],
        "ingest_copies",
    )


def replayed_requests(requests: DataFrame) -> DataFrame:
    """Hashes of the request_ids that occur more than once: a hash aggregate over eight bytes a row.

    A few thousandths of all ids; two ids of one hash only make two singletons take the
    ordered path of ``dedupe_requests``.
    """
    return (requests.groupBy(F.xxhash64("request_id").alias("request_hash")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).select("request_hash"))


def dedupe_requests(typed: DataFrame, replayed: DataFrame | None = None) -> DataFrame:
    """``earliest_copies`` at the price of a hash lookup for requests that came once.

    Rows whose id hash is among ``replayed`` take the ordered aggregate; all others are
    their own earliest copy.  With ``replayed`` written down (as a pipeline run does) its
    size is known, and while it is small the singletons are not shuffled at all.
    """
    replayed = replayed_requests(typed) if replayed is None else replayed
    keyed = typed.withColumn("request_hash", F.xxhash64("request_id"))
    several = earliest_copies(keyed.join(replayed, "request_hash", "left_semi").drop("request_hash"))
    single = keyed.join(replayed, "request_hash", "left_anti").drop("request_hash")
    if "ingest_copies" not in typed.columns:
        single = single.withColumn("ingest_copies", F.lit(1).cast("long"))
    return single.select(*several.columns).unionByName(several)


def stg_llm_requests(raw: DataFrame, aliases: DataFrame, replayed: DataFrame | None = None) -> DataFrame:
    """M03 - typed, deduplicated, alias-mapped, defect-flagged requests."""
    return stage_typed_requests(_typed_requests(raw), aliases, replayed)


def stage_typed_requests(typed: DataFrame, aliases: DataFrame, replayed: DataFrame | None = None) -> DataFrame:
    """M03 from typed rows, which ``dedupe_requests`` reads twice: written ones are not derived from the feed again."""
    return finish_requests(dedupe_requests(typed, replayed), aliases)


def typed_requests(raw: DataFrame) -> DataFrame:
    """Typed request rows (before deduplication)."""
    return _typed_requests(raw)


def finish_requests(d: DataFrame, aliases: DataFrame) -> DataFrame:
    """Alias mapping, recomputed tokens, defect flags and buckets of deduplicated rows."""
    a = F.broadcast(aliases.select("model_name_alias", "model_name_canonical"))  # fixed seed
    j = d.join(a, d.model_name_raw == a.model_name_alias, "left")
    return derived_columns(j.withColumns({
        "model_name": F.coalesce("model_name_canonical", "model_name_raw"),
        "has_model_alias": F.col("model_name_alias").isNotNull(),
        "had_duplicate_ingest": F.col("ingest_copies") > 1,
    }))


#: The columns of M03 that all others follow from.
BASE_COLUMNS = [
    "request_id", "conversation_id", "created_at", "ingested_at", "model_provider", "model_name_raw", "model_name",
    "prompt_tokens", "completion_tokens", "raw_total_tokens", "raw_latency_ms", "recorded_cost_usd", "status", "error_type",
    "has_model_alias", "had_duplicate_ingest",
]


def derived_columns(j: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """M03 rows from their ``BASE_COLUMNS``, with ``more`` columns at the end."""
    pt, ct = F.col("prompt_tokens"), F.col("completion_tokens")
    total = pt + ct
    raw_lat = F.col("raw_latency_ms")
    return j.select(
        "request_id",
        "conversation_id",
        "created_at",
        "ingested_at",
        F.col("created_at").cast("date").alias("request_date"),
        "model_provider",
        "model_name_raw",
        "model_name",
        "prompt_tokens",
        "completion_tokens",
        total.alias("total_tokens"),
        "raw_total_tokens",
        F.when(raw_lat >= 0, raw_lat).alias("latency_ms"),
        "raw_latency_ms",
        "recorded_cost_usd",
        "status",
        "error_type",
        (F.col("status") == "success").alias("is_success"),
        F.col("status").isin("error", "timeout", "rate_limited").alias("is_failed"),
        F.col("conversation_id").isNull().alias("is_orphan"),
        (raw_lat < 0).alias("has_invalid_latency"),
        (F.col("raw_total_tokens") != total).alias("has_token_sum_mismatch"),
        "has_model_alias",
        "had_duplicate_ingest",
        (minute_boundaries_between("created_at", "ingested_at") > 60).alias("is_late_arriving"),
        F.when(total < 500, "0-499").when(total < 1000, "500-999").when(total < 2000, "1000-1999")
        .when(total < 4000, "2000-3999").otherwise("4000+").alias("token_bucket"),
        # NULL raw latency matches no branch and falls to '15s+', as in the reference
        F.when(raw_lat < 0, F.lit(None).cast("string")).when(raw_lat < 1000, "<1s")
        .when(raw_lat < 3000, "1-3s").when(raw_lat < 6000, "3-6s").when(raw_lat < 15000, "6-15s")
        .otherwise("15s+").alias("latency_bucket"),
        *more,
    )


def stg_intent_predictions(raw: DataFrame) -> DataFrame:
    """M04 - the label exists on the human-reviewed subset only."""
    typed = raw.select(
        F.col("prediction_id"),
        F.col("conversation_id"),
        text_cast("created_at", "timestamp").alias("predicted_at"),
        lower_trim("predicted_intent").alias("predicted_intent"),
        text_cast("confidence", "decimal(5,3)").alias("confidence"),
        blank_to_null(F.lower("human_corrected_intent")).alias("human_corrected_intent"),
        text_cast("is_correct", "boolean").alias("is_correct"),
    )
    label, conf = F.col("human_corrected_intent"), F.col("confidence")
    return typed.select(
        "*",
        label.isNotNull().alias("is_human_reviewed"),
        (label.isNotNull() & (label != F.col("predicted_intent"))).alias("is_corrected"),
        F.when(conf >= 0.9, "0.90-1.00").when(conf >= 0.8, "0.80-0.89").when(conf >= 0.7, "0.70-0.79")
        .when(conf >= 0.5, "0.50-0.69").otherwise("<0.50").alias("confidence_bucket"),
    )


def stg_escalations(raw: DataFrame) -> DataFrame:
    """M05 - one hand-off record per escalated conversation."""
    return raw.select(
        F.col("escalation_id"),
        F.col("conversation_id"),
        text_cast("created_at", "timestamp").alias("escalated_at"),
        lower_trim("reason").alias("escalation_reason"),
        lower_trim("handled_by_team").alias("handled_by_team"),
        text_cast("time_to_handoff_seconds", "int").alias("time_to_handoff_seconds"),
    )


def stg_daily_model_prices(raw: DataFrame) -> DataFrame:
    """M06 - one price row per (date, provider, model)."""
    return raw.select(
        text_cast("price_date", "date").alias("price_date"),
        lower_trim("model_provider").alias("model_provider"),
        F.trim("model_name").alias("model_name"),
        text_cast("input_price_per_1k_tokens", "decimal(12,8)").alias("input_price_per_1k_tokens"),
        text_cast("output_price_per_1k_tokens", "decimal(12,8)").alias("output_price_per_1k_tokens"),
    )
