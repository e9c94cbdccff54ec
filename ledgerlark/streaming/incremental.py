"""X07 - incremental request staging with Structured Streaming.

Request extracts keep landing as CSV files.  A file-source stream picks them up and
``foreachBatch`` appends each micro-batch, typed and deduplicated within itself, to
a state table: the earliest copy of every request of the batch with the number of
copies seen, in a folder named by the batch id.  A manifest lists the live folders.

* *Exact.*  ``staged_requests`` runs the same keep-earliest aggregate over the state,
  summing copy counts.  Minimum and sum do not care how copies were split, so the
  result equals batch staging wherever and whenever a replay arrives: on another
  date, in a later batch, or without any date.
* *Retry-safe.*  ``foreachBatch`` may run a batch again; a batch writes a folder of its
  own and one rename of the manifest makes it live in place of an earlier try, so nothing
  counts twice.  A batch that a fold already holds is left alone.
* *Bounded reads.*  A micro-batch writes its own rows only.  Every ``FOLD_AFTER`` batches
  of a level are folded into one folder of the next level (earliest copies, summed counts)
  while the stream goes on, so a read meets at most ``FOLD_AFTER`` folders a level, and a row is
  rewritten once a level: as often as the logarithm of the number of batches.
* *One step.*  Readers resolve the manifest once.  A crash between the write of a fold
  and the rename leaves the old folders live; ``expire_state`` deletes what no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.staging import dedupe_requests, earliest_copies, finish_requests, replayed_requests, typed_requests
from ledgerlark.plans.pipeline import CODEC, read_pointer, replace_pointer
from ledgerlark.sources.landing import CSV_OPTIONS, FEED_COLUMNS, text_schema, unbalanced_lines

MANIFEST = "MANIFEST"
#: Folders of one level that are folded into one of the next.
FOLD_AFTER = 8


def live_folders(spark: SparkSession, state_path: str) -> list[dict]:
    """The manifest's entries: folder, level, and the first and last batch id that it holds."""
    text = read_pointer(spark, f"{state_path}/{MANIFEST}")
    return json.loads(text) if text else []


def _publish(spark: SparkSession, state_path: str, entries: list[dict]) -> None:
    replace_pointer(spark, f"{state_path}/{MANIFEST}", json.dumps(sorted(entries, key=lambda e: e["first"])))


def merge_batch(batch: DataFrame, state_path: str, batch_id: int, fold_after: int = FOLD_AFTER) -> None:
    """Write one micro-batch of raw request rows and make it live; fold levels that are full."""
    spark = batch.sparkSession
    live = live_folders(spark, state_path)
    if any(e["level"] > 0 and e["first"] <= batch_id <= e["last"] for e in live):
        return   # a retry of a batch that a fold holds
    folder = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
    earliest_copies(typed_requests(batch)).write.option("compression", CODEC).parquet(f"{state_path}/{folder}")
    live = [e for e in live if e["first"] != batch_id] + [{"folder": folder, "level": 0, "first": batch_id, "last": batch_id}]
    _publish(spark, state_path, live)
    compact(spark, state_path, fold_after)


def _read(spark: SparkSession, state_path: str, entries: list[dict]) -> DataFrame:
    return spark.read.parquet(*[f"{state_path}/{e['folder']}" for e in entries])


def read_state(spark: SparkSession, state_path: str, replayed: DataFrame | None = None) -> DataFrame:
    """Deduplicated typed requests over all batches, with their copy counts."""
    return dedupe_requests(_read(spark, state_path, live_folders(spark, state_path)), replayed)


def write_replayed(spark: SparkSession, state_path: str, path: str) -> DataFrame:
    """The hashes of the requests that several live folders hold, written down: their size is known to the plans that look them up."""
    replayed_requests(_read(spark, state_path, live_folders(spark, state_path))).write.option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)


def compact(spark: SparkSession, state_path: str, fold_after: int = FOLD_AFTER) -> None:
    """Fold every level that holds ``fold_after`` folders into one folder of the next level."""
    live = live_folders(spark, state_path)
    level = 0
    while level <= max((e["level"] for e in live), default=-1):
        full = [e for e in live if e["level"] == level]
        if len(full) >= fold_after:
            folder = f"fold-{level + 1}-{uuid.uuid4().hex[:8]}"
            dedupe_requests(_read(spark, state_path, full)).write.option("compression", CODEC).parquet(f"{state_path}/{folder}")
            live = [e for e in live if e["level"] != level] + [
                {"folder": folder, "level": level + 1, "first": min(e["first"] for e in full), "last": max(e["last"] for e in full)}]
            _publish(spark, state_path, live)
        level += 1


def expire_state(spark: SparkSession, state_path: str) -> list[str]:
    """Delete folders that the manifest does not name; to be called when no reader of an older manifest is left."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(state_path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    live = {e["folder"] for e in live_folders(spark, state_path)}
    gone = sorted({f.getPath().getName() for f in fs.listStatus(base) if f.isDirectory()} - live)
    for name in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(base, name), True)
    return gone


def _stop_on_unbalanced(batch: DataFrame) -> None:
    """Read the lines of the micro-batch's files (at most ``max_files_per_trigger``) and stop at an unbalanced quote."""
    files = [r.file for r in batch.select("file").distinct().collect()]
    if files and (bad := unbalanced_lines(batch.sparkSession, *files).first()):
        raise ValueError(f"unbalanced quote in {bad.file}")


def start_incremental_staging(spark: SparkSession, landing_dir: str, state_path: str, stream_checkpoint: str,
                              available_now: bool = True, max_files_per_trigger: int | None = None,
                              attempts: int = 1, fold_after: int = FOLD_AFTER, expire: bool = False):
    """Start the stream (file source -> foreachBatch append); returns the StreamingQuery.

    ``attempts`` above 1 merges every batch that often, as a failing sink would.  ``expire`` deletes the folders
    that a merge has replaced: for a state that nobody reads while the stream goes on.
    """
    reader = spark.readStream.schema(text_schema(FEED_COLUMNS["llm_requests"])).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing_dir).select("*", F.col("_metadata.file_path").alias("file"))

    def merge(df: DataFrame, batch_id: int) -> None:
        _stop_on_unbalanced(df)
        for _ in range(attempts):
            merge_batch(df.drop("file"), state_path, batch_id, fold_after)
            if expire:
                expire_state(df.sparkSession, state_path)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", stream_checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def staged_requests(spark: SparkSession, state_path: str, aliases: DataFrame, replayed: DataFrame | None = None) -> DataFrame:
    """M03 rows from the incremental state; ``replayed``: see ``write_replayed``."""
    return finish_requests(read_state(spark, state_path, replayed), aliases)
