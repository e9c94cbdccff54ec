"""Landing zone (S01-S05, S10 input): raw text feeds in, nothing inferred.

An upstream extract is a folder of CSV files per feed.  ``land_feeds`` reads it
strictly (the header must name the declared columns in order, quotes are doubled,
a row with too few or too many fields stops the load), stamps every row with the
load time and writes the landed tables; ``read_feeds`` reads those.  The stamp is
stored, so the age of a table is the age of its load, not of the query.

A line is a row, so Spark splits a large file over many tasks; a line with an
unbalanced quote stops the load and names its file.  Only a feed declared to hold
line breaks inside quotes (``line_breaks``) is parsed one file a task.

Every feed column is declared ``StringType`` - types are assigned in staging.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of each landing feed (all text).
FEED_COLUMNS: dict[str, list[str]] = {
    "users": ["user_id", "created_at", "country", "segment", "signup_channel"],
    "conversations": ["conversation_id", "user_id", "started_at", "ended_at", "channel", "initial_intent",
                      "resolved_without_escalation", "escalated", "satisfaction_score"],
    "llm_requests": ["request_id", "conversation_id", "created_at", "model_provider", "model_name",
                     "prompt_tokens", "completion_tokens", "total_tokens", "latency_ms", "cost_usd", "status",
                     "error_type", "_ingested_at"],
    "intent_predictions": ["prediction_id", "conversation_id", "created_at", "predicted_intent", "confidence",
                           "human_corrected_intent", "is_correct"],
    "escalations": ["escalation_id", "conversation_id", "created_at", "reason", "handled_by_team",
                    "time_to_handoff_seconds"],
    "daily_model_prices": ["price_date", "model_provider", "model_name", "input_price_per_1k_tokens",
                           "output_price_per_1k_tokens"],
}
MANIFEST_COLUMNS = ["table_name", "key_column", "key_value", "issue"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


#: Strict CSV: the header is checked, quotes are doubled inside quotes, blanks are kept, bad rows stop the read.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "quote": '"', "escape": '"', "mode": "FAILFAST",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "false", "columnPruning": "false"}


def _lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(value, file, odd) of every line; odd: with an odd number of quotes, so it cannot be a whole row."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), (quotes % 2 == 1).alias("odd"))


def unbalanced_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(value, file) of the lines with an unbalanced quote."""
    return _lines(spark, *paths).where("odd").select("value", "file")


def read_csv(spark: SparkSession, path: str, columns: list[str], line_breaks: bool = False) -> DataFrame:
    """All-text CSV with a checked header.

    Column pruning is off for the parser to see whole rows: a row with too few or
    too many fields stops the read even if a query needs none of its columns.
    The line check is part of the plan (a branch that yields no row), so it runs with
    the same job as the read.  ``line_breaks``: quoted fields may span lines.
    """
    rows = spark.read.schema(text_schema(columns)).options(**CSV_OPTIONS).option("multiLine", line_breaks).csv(path)
    if line_breaks:
        return rows
    stop = F.when(F.col("odd"), F.raise_error(F.concat(F.lit("unbalanced quote in "), F.col("file"))).cast("boolean")).otherwise(False)
    return rows.unionByName(_lines(spark, path).where(stop).select(*[F.col("value").alias(c) for c in columns]))


def read_landing(spark: SparkSession, path: str, name: str, line_breaks: bool = False) -> DataFrame:
    """S01 - one CSV extract, every column text."""
    return read_csv(spark, path, FEED_COLUMNS[name], line_breaks)


def write_feeds(feeds: dict[str, DataFrame], root: str) -> None:
    """Write feeds as CSV extracts, one folder per feed (overwrite = idempotent); blanks and quotes survive."""
    for name, df in feeds.items():
        write_csv(df.select(*FEED_COLUMNS[name]), f"{root}/{name}")


def write_csv(df: DataFrame, path: str, codec: str = "none") -> None:
    """``codec``: ``gzip`` for files that one task reads whole anyway, a packed file is not split."""
    (df.write.mode("overwrite").option("compression", codec).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def land_feeds(spark: SparkSession, extracts: str, root: str, loaded_at: str | None = None, line_breaks: tuple[str, ...] = ()) -> None:
    """S01/S02 - load the six extracts into landed tables stamped with the load time (full refresh).

    ``line_breaks``: the feeds whose quoted fields may hold line breaks.
    """
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    for name in FEED_COLUMNS:
        df = read_landing(spark, f"{extracts}/{name}", name, name in line_breaks).withColumn("_loaded_at", stamp)
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def read_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """S02 - the six landed tables of a landing folder (``root/<feed>/``), with their load times."""
    return {name: spark.read.parquet(f"{root}/{name}").select(*FEED_COLUMNS[name], "_loaded_at") for name in FEED_COLUMNS}


def write_manifest(manifest: DataFrame, path: str) -> None:
    """S03 - land the ground-truth manifest of injected defects (no load stamp)."""
    write_csv(manifest.select(*MANIFEST_COLUMNS), path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """S03 - the landed manifest."""
    return read_csv(spark, path, MANIFEST_COLUMNS)


def landing_counts(feeds: dict[str, DataFrame]) -> DataFrame:
    """S04 - (table_name, n_rows) per landing table, one partial-aggregated pass each."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(f"raw_{n}").alias("table_name"), "n_rows")
             for n, df in feeds.items()]
    return reduce(DataFrame.unionByName, parts)
