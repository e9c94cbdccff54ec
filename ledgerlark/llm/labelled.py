"""Bounded training samples for the classifiers: labelled rows outside the evaluation fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import columns_as, held_out


def training_rows(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents outside the evaluation fold.

    The sample is the ``most`` labelled ids with the smallest hash.  Labels of a
    repeated doc_id are averaged (0.5 and more is 1); null labels and ids are left out.
    Of rows that repeat an id the smallest text counts, so ``most`` bounds the rows too.
    The id list is bounded by ``most``, so it is broadcast; texts are reduced to one
    an id before they are shuffled.
    """
    ids = (columns_as(labels, "doc_id", target).where(f"doc_id is not null and `{target}` is not null")
           .groupBy("doc_id").agg((F.avg(target) >= 0.5).cast("int").alias("label"))
           .where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = columns_as(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")
