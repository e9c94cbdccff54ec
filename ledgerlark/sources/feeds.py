"""Raw landing feeds derived from the driver's TPC-H-shaped tables.

The warehouse consumes six text feeds (users, conversations, LLM requests, intent
predictions, escalations, daily model prices).  The test harness ships TPC-H-like
parquet tables instead, so this module maps them onto the feeds with the
deterministic integer rules of FIXTURES.md §2.  Every derived column is plain
column arithmetic over the driver rows: the feeds scale with the inputs, run
fully distributed, and need exactly two joins (customer->nation, which is a
broadcastable 25-row dimension, and lineitem->orders on the order key).

All feed columns are text, as on a real landing zone.  Timestamps are produced
with TIMESTAMP_NTZ arithmetic so the text never depends on the session zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.exprs import pick
from ledgerlark.sources.seeds import INTENTS, MODEL_NAMES

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md §2).
# ---------------------------------------------------------------------------
WINDOW_START = "2024-01-01"          # W0, a Monday
PRICE_DAYS = 92                      # price sheet covers days 0..91
MODEL_PROVIDERS = ["openai", "openai", "anthropic", "anthropic", "google"]
INPUT_PRICES = ["0.00015", "0.00200", "0.00100", "0.00300", "0.00030"]
OUTPUT_PRICES = ["0.00060", "0.00800", "0.00500", "0.01500", "0.00250"]
PRICE_CUT_DAY = 45                   # model 1 becomes cheaper from this day
PRICE_CUT_INPUT = "0.00160"
PRICE_CUT_OUTPUT = "0.00640"
STALE_COST_FACTORS = {1: "1.25", 3: "1.20", 4: "1.50"}
SIGNUP_CHANNEL_CYCLE = ["organic", "paid_social", "referral", "partner"]
CHANNEL_CYCLE = ["mobile_app", " Web", "whatsapp"]
REASON_CYCLE = ["policy_requires_human", "low_confidence", "user_requested_agent",
                "unresolved_after_retry", "fraud_suspected", "llm_failure"]
TEAM_CYCLE = ["tier1_support", "disputes", "kyc_compliance", "fraud_ops"]
INCIDENT_DAY = 41
# ---------------------------------------------------------------------------



def w0_ntz() -> Column:
    return F.lit(WINDOW_START).cast("timestamp_ntz")


def w0_date() -> Column:
    return F.lit(WINDOW_START).cast("date")


def ts_text(day: Column, seconds: Column) -> Column:
    """Text of ``W0 + day days + seconds seconds`` (``yyyy-MM-dd HH:mm:ss``)."""
    total = day.cast("long") * F.lit(86400) + seconds.cast("long")
    return F.timestamp_add("SECOND", total, w0_ntz()).cast("string")


def as_text(c: Column) -> Column:
    return c.cast("string")


def price_columns(model_idx: Column, day: Column) -> tuple[Column, Column]:
    """Input / output price per 1k tokens (DECIMAL(12,8)) of model ``m`` on day ``d``."""
    cut = (model_idx == F.lit(1)) & (day >= F.lit(PRICE_CUT_DAY))

    def sheet(values: list[str], cut_value: str) -> Column:
        base = pick(model_idx, values).cast("decimal(12,8)")
        return F.when(cut, F.lit(cut_value).cast("decimal(12,8)")).otherwise(base)

    return sheet(INPUT_PRICES, PRICE_CUT_INPUT), sheet(OUTPUT_PRICES, PRICE_CUT_OUTPUT)


@dataclass(frozen=True)
class DriverTables:
    """Lazy readers of the driver parquet tables (column pruning happens in Catalyst)."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def user_keys(t: DriverTables) -> DataFrame:
    """customer ⋈ nation, keyed by customer key (the nation side has 25 rows)."""
    c = t.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.table("nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner")


def signup_day(k: Column) -> Column:
    return (k * F.lit(37)) % F.lit(200) - F.lit(110)


def raw_users(t: DriverTables) -> DataFrame:
    u = user_keys(t)
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return u.select(
        F.concat(F.lit("u_"), as_text(k)).alias("user_id"),
        ts_text(signup_day(k), (k * F.lit(7919)) % F.lit(43200)).alias("created_at"),
        F.concat(F.lit(" "), F.lower(F.substring("n_name", 1, 2))).alias("country"),
        F.when(seg == "BUILDING", "business")
        .when(seg == "AUTOMOBILE", "Premium")
        .when(seg == "MACHINERY", "premium ")
        .otherwise("retail").alias("segment"),
        pick(k % F.lit(4), SIGNUP_CHANNEL_CYCLE).alias("signup_channel"),
    )


def conversation_base(t: DriverTables) -> DataFrame:
    """One row per order that becomes a conversation, with the integer drivers.

    Columns: ok, uk, dy (day index), sec (start second), dur, it (intent index),
    esc (escalated), prio.  Orders of customers that have no user row are dropped
    (semi-join), as are orders with ``o_custkey % 17 = 5``.
    """
    o = (
        t.table("orders")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .where((F.col("o_custkey") % F.lit(17)) != F.lit(5))
    )
    users = user_keys(t).select(F.col("c_custkey"))
    o = o.join(users, o.o_custkey == users.c_custkey, "left_semi")
    ok, uk = F.col("o_orderkey"), F.col("o_custkey")
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    dy = F.greatest(days % F.lit(90), signup_day(uk))
    base = o.select(
        ok.alias("ok"),
        uk.alias("uk"),
        dy.cast("int").alias("dy"),
        (F.lit(43200) + (ok * F.lit(104729)) % F.lit(43200)).alias("sec"),
        (F.lit(60) + (ok * F.lit(31)) % F.lit(900)).alias("dur"),
        ((ok * F.lit(7) + uk) % F.lit(12)).cast("int").alias("it"),
        F.col("o_orderpriority").alias("prio"),
    )
    return base.withColumn(
        "esc",
        (F.col("prio") == "1-URGENT")
        | ((F.col("dy") == F.lit(INCIDENT_DAY)) & ((F.col("ok") % F.lit(4)) == F.lit(0))),
    )


def raw_conversations(t: DriverTables, base: DataFrame | None = None, clean: bool = False) -> DataFrame:
    """``clean=True`` leaves out the fixture's contradictory resolution flags."""
    b = base if base is not None else conversation_base(t)
    ok, uk, dy, sec, dur, esc = (F.col(c) for c in ("ok", "uk", "dy", "sec", "dur", "esc"))
    resolved = ((~esc) & (F.col("prio") != "5-LOW"))
    if not clean:
        resolved = resolved | (esc & ((ok % F.lit(251)) == F.lit(0)))
    unrated = ((ok * F.lit(5) + uk) % F.lit(3)) == F.lit(0)
    score = F.concat(as_text(F.lit(1) + (ok * F.lit(11) + uk) % F.lit(5)), F.lit(".0"))
    return b.select(
        F.concat(F.lit("c_"), as_text(ok)).alias("conversation_id"),
        F.concat(F.lit("u_"), as_text(uk)).alias("user_id"),
        ts_text(dy, sec).alias("started_at"),
        ts_text(dy, sec + dur).alias("ended_at"),
        pick((ok + uk) % F.lit(3), CHANNEL_CYCLE).alias("channel"),
        pick(F.col("it"), INTENTS).alias("initial_intent"),
        F.when(resolved, "True").otherwise("False").alias("resolved_without_escalation"),
        F.when(esc, "True").otherwise("False").alias("escalated"),
        F.when(unrated, "").otherwise(score).alias("satisfaction_score"),
    )


def raw_intent_predictions(t: DriverTables, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else conversation_base(t)
    ok, uk, it = F.col("ok"), F.col("uk"), F.col("it")
    wrong = ((ok * F.lit(131) + uk * F.lit(7)) % F.lit(100)) < F.lit(12)
    reviewed = ((ok * F.lit(37) + uk) % F.lit(10)) < F.lit(3)
    predicted = F.when(wrong, (it + F.lit(1)) % F.lit(12)).otherwise(it)
    return b.select(
        F.concat(F.lit("p_"), as_text(ok)).alias("prediction_id"),
        F.concat(F.lit("c_"), as_text(ok)).alias("conversation_id"),
        ts_text(F.col("dy"), F.col("sec") + F.lit(2)).alias("created_at"),
        pick(predicted, INTENTS).alias("predicted_intent"),
        F.concat(F.lit("0."), as_text(F.lit(300) + (ok * F.lit(7919) + uk) % F.lit(700))).alias("confidence"),
        F.when(reviewed, pick(it, INTENTS)).otherwise("").alias("human_corrected_intent"),
        F.when(reviewed, F.when(wrong, "False").otherwise("True")).otherwise("").alias("is_correct"),
    )


def raw_escalations(t: DriverTables, base: DataFrame | None = None) -> DataFrame:
    b = (base if base is not None else conversation_base(t)).where(F.col("esc"))
    ok, uk, dy = F.col("ok"), F.col("uk"), F.col("dy")
    hand = F.lit(15) + (ok * F.lit(41)) % F.lit(600)
    created = ts_text(dy, F.col("sec") + F.col("dur") - F.floor(hand / F.lit(2)))
    reason = F.when(
        (dy == F.lit(INCIDENT_DAY)) & ((ok % F.lit(2)) == F.lit(0)), F.lit("llm_failure")
    ).otherwise(pick((ok * F.lit(11) + uk) % F.lit(6), REASON_CYCLE))
    return b.select(
        F.concat(F.lit("e_"), as_text(ok)).alias("escalation_id"),
        F.concat(F.lit("c_"), as_text(ok)).alias("conversation_id"),
        created.alias("created_at"),
        reason.alias("reason"),
        pick((ok + uk) % F.lit(4), TEAM_CYCLE).alias("handled_by_team"),
        as_text(hand).alias("time_to_handoff_seconds"),
    )


def raw_daily_model_prices(spark: SparkSession, days: int = PRICE_DAYS) -> DataFrame:
    """Price sheet: one row per (day, model); ``days x 5`` rows, a bounded dimension."""
    n_models = len(MODEL_NAMES)
    grid = spark.range(days * n_models).select(
        (F.col("id") / F.lit(n_models)).cast("int").alias("d"), (F.col("id") % F.lit(n_models)).cast("int").alias("m"))
    inp, out = price_columns(F.col("m"), F.col("d"))
    return grid.select(
        F.date_add(w0_date(), F.col("d")).cast("string").alias("price_date"),
        pick(F.col("m"), MODEL_PROVIDERS).alias("model_provider"),
        pick(F.col("m"), MODEL_NAMES).alias("model_name"),
        inp.cast("string").alias("input_price_per_1k_tokens"),
        out.cast("string").alias("output_price_per_1k_tokens"),
    )


def raw_llm_requests(t: DriverTables, base: DataFrame | None = None, clean: bool = False) -> DataFrame:
    """lineitem ⋈ conversations on the order key, one request per line item.

    ``clean=True`` switches every fixture defect off (input of defect injection).

    Replays are emitted by exploding a 1- or 2-element array (one pass, no union),
    so the feed is produced by a single join stage.
    """
    b = (base if base is not None else conversation_base(t)).select("ok", "uk", "dy", "sec")
    li = t.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    j = li.join(b, li.l_orderkey == b.ok, "inner")
    ok, dy, sec = F.col("ok"), F.col("dy"), F.col("sec")
    ln, pk, sk = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    qty = F.col("l_quantity").cast("int")
    rs = sec + ln * F.lit(97) + pk % F.lit(60)
    rd = F.when(rs >= F.lit(86400), dy + F.lit(1)).otherwise(dy)
    m = ((pk + sk) % F.lit(5)).cast("int")
    k = (pk * F.lit(7) + ok * F.lit(13) + ln) % F.lit(1000)
    incident = (rd == F.lit(INCIDENT_DAY)) & (m < F.lit(2))
    status = F.when(
        incident,
        F.when(k < 700, "success").when(k < 880, "error").otherwise("timeout"),
    ).otherwise(
        F.when(k < 955, "success").when(k < 977, "error").when(k < 992, "timeout").otherwise("rate_limited")
    )
    j = j.select(
        ok, dy, ln, pk, sk, qty.alias("qty"), F.col("l_extendedprice").alias("ep"),
        rs.alias("rs"), rd.alias("rd"), m.alias("m"), status.alias("status"),
    )
    ok, ln, pk, sk, qty, m, st = (F.col(c) for c in ("ok", "l_linenumber", "l_partkey", "l_suppkey", "qty", "m", "status"))
    e = (pk + ok) % F.lit(20)
    error_type = (
        F.when(st == "error",
               F.when(e < 9, "provider_5xx").when(e < 13, "content_filter")
               .when(e < 17, "invalid_request").otherwise("context_length"))
        .when(st == "timeout", "upstream_timeout")
        .when(st == "rate_limited", "rate_limit_429")
        .otherwise("")
    )
    pt = F.lit(120) + qty * F.lit(37) + ln * F.lit(180)
    ct = (
        F.when(st == "success", F.lit(20) + F.floor(F.col("ep") / F.lit(100)))
        .when(st == "error", (pk * F.lit(3)) % F.lit(40))
        .otherwise(F.lit(0))
    ).cast("int")
    j = j.select("*", error_type.alias("error_type"), pt.cast("int").alias("pt"), ct.alias("ct"))
    pt, ct = F.col("pt"), F.col("ct")
    latency = (
        F.when(st == "timeout", F.lit(30000) + (pk * F.lit(17) + ok) % F.lit(30000))
        .when(st == "rate_limited", F.lit(50) + pk % F.lit(350))
        .otherwise(F.lit(400) + ct * F.lit(11) + (pk * F.lit(13) + sk) % F.lit(900))
    )
    inp, out = price_columns(m, F.col("rd"))
    true_cost = F.round((pt * inp + ct * out) * F.lit("0.001").cast("decimal(4,3)"), 6).cast("decimal(12,6)")
    stale = F.lit(False) if clean else ((ok + pk * F.lit(7)) % F.lit(101)) == F.lit(11)
    factor = F.coalesce(
        *[F.when(m == F.lit(i), F.lit(f).cast("decimal(3,2)")) for i, f in STALE_COST_FACTORS.items()],
        F.lit("1.00").cast("decimal(3,2)"),
    )
    logged_cost = F.when(stale, F.round(true_cost * factor, 6).cast("decimal(12,6)")).otherwise(true_cost)
    orphan = ((pk * ln + ok) % F.lit(499)) == F.lit(0)
    alias = ((ok + pk * F.lit(3)) % F.lit(503)) == F.lit(7)
    neg_latency = ((ok * F.lit(3) + pk) % F.lit(997)) == F.lit(5)
    token_gap = (pk % F.lit(199)) == F.lit(3)
    late = ((ok * F.lit(5) + pk) % F.lit(251)) == F.lit(9)
    replay = ((ok + pk) % F.lit(331)) == F.lit(1)
    if clean:
        orphan = alias = neg_latency = token_gap = late = replay = F.lit(False)
    late_secs = F.when(late, (F.lit(2) + ok % F.lit(4)) * F.lit(86400)).otherwise(F.lit(0))
    copies = F.explode(F.when(replay, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    j = j.select("*", copies.alias("copy"))
    ingest_secs = F.col("rs") + F.lit(1) + pk % F.lit(89) + late_secs + F.col("copy") * F.lit(300)
    model = pick(m, MODEL_NAMES)
    return j.select(
        F.concat_ws("_", F.lit("r"), as_text(ok), as_text(ln), as_text(pk), as_text(sk), as_text(qty)).alias("request_id"),
        F.when(orphan, "").otherwise(F.concat(F.lit("c_"), as_text(ok))).alias("conversation_id"),
        ts_text(F.col("dy"), F.col("rs")).alias("created_at"),
        pick(m, MODEL_PROVIDERS).alias("model_provider"),
        F.when(alias, F.concat(model, F.lit("-preview"))).otherwise(model).alias("model_name"),
        as_text(pt).alias("prompt_tokens"),
        as_text(ct).alias("completion_tokens"),
        as_text(pt + ct + F.when(token_gap, F.lit(100)).otherwise(F.lit(0))).alias("total_tokens"),
        as_text(F.when(neg_latency, -latency).otherwise(latency)).alias("latency_ms"),
        as_text(logged_cost).alias("cost_usd"),
        st.alias("status"),
        F.col("error_type"),
        ts_text(F.col("dy"), ingest_secs).alias("_ingested_at"),
    )


FEED_NAMES = ("users", "conversations", "llm_requests", "intent_predictions", "escalations", "daily_model_prices")


def derive_feeds(spark: SparkSession, root: str, clean: bool = False) -> dict[str, DataFrame]:
    """All six raw feeds, keyed by feed name (lazy; nothing is computed here)."""
    t = DriverTables(spark, root)
    base = conversation_base(t)
    return {
        "users": raw_users(t),
        "conversations": raw_conversations(t, base, clean),
        "llm_requests": raw_llm_requests(t, base, clean),
        "intent_predictions": raw_intent_predictions(t, base),
        "escalations": raw_escalations(t, base),
        "daily_model_prices": raw_daily_model_prices(spark),
    }
