"""Spark session defaults for the warehouse.

The warehouse treats timestamps as wall-clock values (the landing feeds carry
naive text), so the session time zone is pinned to UTC.  ANSI mode stays on:
bad text fails loudly instead of silently turning into NULL.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method of more than 8,000 bytes of code; the typed request feed makes such a stage,
    # which then runs interpreted.  Beyond this limit Spark generates its operators one by one, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the warehouse semantics depend on."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """The jobs started inside delete their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, so the disk holds those of every
    job of a run at once.  Only for jobs whose plans run once: a second run of a plan makes the files again.
    """
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a scratch folder; on a cluster
    executors would each write their own disk, so there it is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # ``spark.checkpoint.dir`` is a core setting that cannot be changed on a
        # running session; the context's checkpoint folder can.
        d = tempfile.mkdtemp(prefix="ledgerlark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlark") -> SparkSession:
    """Session for tests and local benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")   # concurrent pipeline jobs share the cores
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_defaults(spark)
