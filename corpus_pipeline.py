"""Corpus pipeline: quality, line deduplication, near-duplicates, benchmark leaks, source mix.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet in the shared folder and read
again as the next one's ``docs``.  All but the last return the columns of
``documents``.  Null and repeated rows, empty texts, empty tables and extra columns
are handled as the operators' docstrings say: a row without doc_id is never removed
as a near-duplicate or a leak, and of rows that repeat a doc_id one remains after
the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm.common import cut, release_shuffles, table
from ledgerlark.llm.decontaminate import drop_contaminated
from ledgerlark.llm.line_dedup import drop_repeated_lines
from ledgerlark.llm.mixing import mix_sources
from ledgerlark.llm.near_dup import drop_near_duplicates
from ledgerlark.llm.quality_rules import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of two lines or more that earlier documents hold."""
    return drop_repeated_lines(docs, runs=True)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at 0.8 similarity of five-word shingle sets."""
    return drop_near_duplicates(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item at 80 % of its five-word shingles."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, mixed by source temperature: rows (doc_id, source, epoch, n_tokens, weight, position)."""
    return mix_sources(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dup", near_dup), ("decontaminate", decontaminate), ("mix", mix)]

#: A trained classifier and connected components are not for one SQL statement; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
        release_shuffles(spark)
    return docs
