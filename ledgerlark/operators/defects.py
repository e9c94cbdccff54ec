"""X01 seeded defect injection and X02 manifest reconciliation.

X01 turns clean landing feeds into messy ones at set rates and records every
injected defect in a manifest (table_name, key_column, key_value, issue).  Each
request draws one 32-bit uniform from ``md5(seed:request_id)``; the unit range
is cut into consecutive intervals, one per issue class, so classes are mutually
exclusive by construction and the draw is a pure column expression - fully
distributed, deterministic, and reproducible in any SQL engine with ``md5``.
Rates are expected rates (Bernoulli per row), not exact counts: an exact count
would need a global ranking of all rows.

X02 compares the manifest with the staging flags the warehouse raises on the
injected feeds: per issue, expected / detected / missed / extra keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Issue classes with their injection rates, and the lagging
# price-sheet multipliers behind stale logged costs.
# ---------------------------------------------------------------------------
REQUEST_ISSUES = [
    ("duplicate_request_id", 0.003),
    ("missing_conversation_id", 0.002),
    ("negative_latency", 0.001),
    ("token_sum_mismatch", 0.005),
    ("unknown_model_name", 0.002),
    ("late_arriving_request", 0.004),
    ("stale_price_cost", 0.010),
]
CONFLICT_ISSUE = ("resolved_and_escalated", 0.004)
LEGACY_PRICE_MULTIPLIER = {"gpt-4.1": "1.25", "claude-sonnet-4-5": "1.20", "gemini-2.5-flash": "1.50"}
REPLAY_DELAY_SECONDS = 300
# ---------------------------------------------------------------------------
UNIT = 1 << 32
DEFAULT_SEED = 42


def draw(seed: int, key: Column, part: int = 0) -> Column:
    """A 32-bit uniform integer in [0, 2^32) from ``md5(seed:key)`` (part 0 or 1)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(h, 1 + 8 * part, 8), 16, 10).cast("long")


def issue_bounds() -> list[tuple[str, int, int]]:
    """[(issue, lo, hi)] integer intervals of the request draw, in class order."""
    out, acc = [], 0.0
    for issue, rate in REQUEST_ISSUES:
        lo = int(acc * UNIT)
        acc += rate
        out.append((issue, lo, int(acc * UNIT)))
    return out


def _shift_text(ts_text: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts_text.cast("timestamp_ntz")).cast("string")


def inject_request_defects(requests: DataFrame, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """Messy request feed + its manifest rows.  One pass; replays via a 1-or-2 array explode."""
    v = draw(seed, F.col("request_id"))
    v2 = draw(seed, F.col("request_id"), 1)
    issue = F.lit(None).cast("string")
    for name, lo, hi in reversed(issue_bounds()):
        issue = F.when((v >= F.lit(lo)) & (v < F.lit(hi)), F.lit(name)).otherwise(issue)
    factor = F.coalesce(*[F.when(F.col("model_name") == m, F.lit(f).cast("decimal(3,2)"))
                          for m, f in LEGACY_PRICE_MULTIPLIER.items()])
    r = requests.select("*", issue.alias("_issue"), v2.alias("_v2"), factor.alias("_factor"))
    i = F.col("_issue")
    copies = F.explode(F.when(i == "duplicate_request_id", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    r = r.select("*", copies.alias("_copy"))
    latency = F.col("latency_ms").cast("long")
    total = F.col("total_tokens").cast("long")
    cost = F.col("cost_usd").cast("decimal(12,6)")
    messy = r.select(
        "request_id",
        F.when(i == "missing_conversation_id", F.lit("")).otherwise(F.col("conversation_id")).alias("conversation_id"),
        "created_at", "model_provider",
        F.when(i == "unknown_model_name", F.concat("model_name", F.lit("-preview"))).otherwise(F.col("model_name"))
        .alias("model_name"),
        "prompt_tokens", "completion_tokens",
        F.when(i == "token_sum_mismatch", (total + F.lit(50) + F.col("_v2") % F.lit(350)).cast("string"))
        .otherwise(F.col("total_tokens")).alias("total_tokens"),
        F.when(i == "negative_latency", (-latency).cast("string")).otherwise(F.col("latency_ms")).alias("latency_ms"),
        F.when((i == "stale_price_cost") & F.col("_factor").isNotNull(),
               F.round(cost * F.col("_factor"), 6).cast("decimal(12,6)").cast("string"))
        .otherwise(F.col("cost_usd")).alias("cost_usd"),
        "status", "error_type",
        F.when(i == "late_arriving_request",
               _shift_text(F.col("created_at"), (F.lit(2) + F.col("_v2") % F.lit(4)) * F.lit(86400)))
        .when(F.col("_copy") == 1, _shift_text(F.col("_ingested_at"), F.lit(REPLAY_DELAY_SECONDS)))
        .otherwise(F.col("_ingested_at")).alias("_ingested_at"),
    )
    listed = r.where((F.col("_copy") == 0) & i.isNotNull()
                     & ((i != "stale_price_cost") | F.col("_factor").isNotNull()))
    manifest = listed.select(
        F.lit("raw_llm_requests").alias("table_name"), F.lit("request_id").alias("key_column"),
        F.col("request_id").alias("key_value"), i.alias("issue"))
    return messy, manifest


def inject_conversation_defects(conversations: DataFrame, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """Mark a share of escalated conversations as also resolved (contradictory flags).

    The per-row probability among escalated conversations is rate x n / n_escalated,
    taken from a 1-row aggregate (broadcast), so the expected share of all
    conversations equals the rate.
    """
    name, rate = CONFLICT_ISSUE
    esc = F.col("escalated") == "True"
    counts = conversations.agg(F.count(F.lit(1)).alias("_n"), F.count_if(esc).alias("_n_esc"))
    # Nobody escalated: no conversation can be marked, the threshold is 0.
    share = F.coalesce(F.try_divide(F.lit(rate) * F.col("_n"), F.col("_n_esc")), F.lit(0.0))
    threshold = F.floor(share * F.lit(float(UNIT))).cast("long")
    c = conversations.crossJoin(F.broadcast(counts.select(threshold.alias("_t"))))
    hit = esc & (draw(seed, F.col("conversation_id")) < F.col("_t"))
    c = c.select("*", hit.alias("_hit"))
    messy = c.select(*[
        F.when(F.col("_hit"), F.lit("True")).otherwise(F.col(x)).alias(x) if x == "resolved_without_escalation"
        else F.col(x) for x in conversations.columns
    ])
    manifest = c.where(F.col("_hit")).select(
        F.lit("raw_conversations").alias("table_name"), F.lit("conversation_id").alias("key_column"),
        F.col("conversation_id").alias("key_value"), F.lit(name).alias("issue"))
    return messy, manifest


def inject_defects(feeds: dict[str, DataFrame], seed: int = DEFAULT_SEED) -> tuple[dict[str, DataFrame], DataFrame]:
    """X01 - feeds with seeded defects, plus the ground-truth manifest."""
    req, m1 = inject_request_defects(feeds["llm_requests"], seed)
    conv, m2 = inject_conversation_defects(feeds["conversations"], seed)
    return {**feeds, "llm_requests": req, "conversations": conv}, m1.unionByName(m2)


# issue -> (dataset, key column, staging flag expression)
DETECTORS = {
    "duplicate_request_id": ("priced_requests", "request_id", "had_duplicate_ingest"),
    "missing_conversation_id": ("priced_requests", "request_id", "is_orphan"),
    "negative_latency": ("priced_requests", "request_id", "has_invalid_latency"),
    "token_sum_mismatch": ("priced_requests", "request_id", "has_token_sum_mismatch"),
    "unknown_model_name": ("priced_requests", "request_id", "has_model_alias"),
    "late_arriving_request": ("priced_requests", "request_id", "is_late_arriving"),
    "stale_price_cost": ("priced_requests", "request_id", "not is_cost_reconciled"),
    "resolved_and_escalated": ("stg_conversations", "conversation_id", "has_conflicting_resolution"),
}


def reconcile_manifest(manifest: DataFrame, wh) -> DataFrame:
    """X02 - per issue: expected (manifest), detected, missed and extra keys.

    Flagged keys of all issues are gathered in one pass per dataset (an
    ``inline`` of the flags), then full-outer-joined with the manifest on
    (issue, key) and counted per issue.
    """
    flagged = None
    by_ds: dict[str, list[str]] = {}
    for issue, (ds, _key, _expr) in DETECTORS.items():
        by_ds.setdefault(ds, []).append(issue)
    for ds, issues in by_ds.items():
        key = DETECTORS[issues[0]][1]
        df = wh.dataset(ds)
        rows = F.array(*[F.struct(F.lit(x).alias("issue"), F.coalesce(F.expr(DETECTORS[x][2]), F.lit(False))
                                  .alias("hit")) for x in issues])
        part = df.select(F.col(key).alias("key_value"), F.inline(rows)).where("hit").select("issue", "key_value")
        flagged = part if flagged is None else flagged.unionByName(part)
    expected = manifest.select("issue", "key_value").distinct().withColumn("_m", F.lit(True))
    found = flagged.distinct().withColumn("_f", F.lit(True))
    j = expected.join(found, ["issue", "key_value"], "full_outer")
    m, f = F.coalesce("_m", F.lit(False)), F.coalesce("_f", F.lit(False))
    return j.groupBy("issue").agg(
        F.count_if(m).alias("expected"),
        F.count_if(m & f).alias("detected"),
        F.count_if(m & ~f).alias("missed"),
        F.count_if(~m & f).alias("extra"),
    )
