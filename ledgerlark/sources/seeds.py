"""Seed reference tables (S05): intent catalogue, model catalogue, model aliases.

They are tiny, fixed-size lookup tables, so they are created as local relations
with explicit schemas and are always safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's seed files for identical
# results.  Order is the catalogue order (it also drives feed derivation).
# ---------------------------------------------------------------------------
INTENT_CATALOG = [
    ("balance_inquiry", "account", "low", False, "User asks for current balance or recent activity"),
    ("transaction_dispute", "disputes", "high", True, "User contests a charge or transaction"),
    ("card_block", "cards", "high", False, "User wants to block or freeze a card"),
    ("card_delivery", "cards", "low", False, "User asks where a physical card is"),
    ("payment_failed", "payments", "medium", False, "A card or transfer payment was declined"),
    ("transfer_status", "payments", "medium", False, "User asks about a pending or missing transfer"),
    ("account_verification", "kyc", "high", True, "Identity or document verification questions"),
    ("loan_inquiry", "lending", "medium", False, "Questions about loan eligibility or terms"),
    ("fee_question", "account", "low", False, "Questions about fees and pricing"),
    ("app_login_issue", "access", "medium", False, "User cannot log in or has 2FA issues"),
    ("limits_change", "account", "medium", False, "User wants to change spending or transfer limits"),
    ("general_question", "other", "low", False, "Anything that does not fit another intent"),
]
MODEL_CATALOG = [
    ("gpt-4o-mini", "openai", "fast", 128000),
    ("gpt-4.1", "openai", "strong", 1000000),
    ("claude-haiku-4-5", "anthropic", "fast", 200000),
    ("claude-sonnet-4-5", "anthropic", "strong", 200000),
    ("gemini-2.5-flash", "google", "fast", 1000000),
]
MODEL_ALIASES = [
    ("gpt-4o-mini-preview", "gpt-4o-mini"),
    ("gpt-4.1-preview", "gpt-4.1"),
    ("claude-haiku-4-5-preview", "claude-haiku-4-5"),
    ("claude-sonnet-4-5-preview", "claude-sonnet-4-5"),
    ("gemini-2.5-flash-preview", "gemini-2.5-flash"),
]
# Domains used by accepted-values checks and fixed-domain report re-indexing.
SEGMENTS = ["retail", "premium", "business"]
SIGNUP_CHANNELS = ["organic", "paid_social", "referral", "partner"]
CHANNELS = ["mobile_app", "web", "whatsapp"]
RESOLUTION_STATUSES = ["auto_resolved", "escalated", "abandoned"]
PROVIDERS = ["openai", "anthropic", "google"]
REQUEST_STATUSES = ["success", "error", "timeout", "rate_limited"]
ESCALATION_REASONS = [
    "policy_requires_human", "low_confidence", "user_requested_agent",
    "unresolved_after_retry", "fraud_suspected", "llm_failure",
]
TEAMS = ["tier1_support", "disputes", "kyc_compliance", "fraud_ops"]
CONFIDENCE_BUCKETS = ["<0.50", "0.50-0.69", "0.70-0.79", "0.80-0.89", "0.90-1.00"]
FAILURE_STATUSES = ["error", "timeout", "rate_limited"]
# ---------------------------------------------------------------------------

INTENTS = [row[0] for row in INTENT_CATALOG]
MODEL_NAMES = [row[0] for row in MODEL_CATALOG]

INTENT_CATALOG_SCHEMA = T.StructType([
    T.StructField("intent", T.StringType(), False),
    T.StructField("intent_category", T.StringType(), True),
    T.StructField("risk_level", T.StringType(), True),
    T.StructField("requires_human_policy", T.BooleanType(), True),
    T.StructField("description", T.StringType(), True),
])
MODEL_CATALOG_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_provider", T.StringType(), True),
    T.StructField("model_tier", T.StringType(), True),
    T.StructField("context_window_tokens", T.IntegerType(), True),
])
MODEL_ALIASES_SCHEMA = T.StructType([
    T.StructField("model_name_alias", T.StringType(), False),
    T.StructField("model_name_canonical", T.StringType(), False),
])


def intent_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INTENT_CATALOG, INTENT_CATALOG_SCHEMA)


def model_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_CATALOG, MODEL_CATALOG_SCHEMA)


def model_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_ALIASES, MODEL_ALIASES_SCHEMA)
