"""Shared helpers of the training-data operators: table access, lineage cuts, Arrow plumbing."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import checkpoint_dir

#: Text bytes handled at once inside a task; bounds the numpy temporaries.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder (see ``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    Ends the lineage: a lost executor costs at most the stages since the last cut.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``cut`` that nothing will read again."""
    for t in tables:
        jvm, sc = t.sparkSession._jvm, t.sparkSession.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(t._llm_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished, no longer referenced jobs.

    Spark removes a shuffle once the driver's garbage collector has found its
    handle; between two large phases that is worth asking for.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def columns_as(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that a caller's extra columns cannot clash with internal ones."""
    return df.select(*[F.col(f"`{n}`").alias(n) for n in names])


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: one document in five by the checksum of its id as text (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string or binary column, nulls as empty rows."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf, offs


def text_slices(arr: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of consecutive rows with about ``most`` bytes; a longer text comes alone."""
    buf, offs = text_buffer(arr)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ledgerlark-")) / "ledgerlark_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(target))   # the driver serves it to every executor
    sc._ledgerlark_shipped = True


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
