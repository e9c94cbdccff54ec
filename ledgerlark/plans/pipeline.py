"""S06-S08, S11 - the pipeline run: seeds -> staging -> intermediate -> marts -> checks.

Every dataset that several written ones read, and every mart, is written once (Parquet,
full refresh) into the run's own folder, by layer, and every downstream dataset is
re-planned on the *written* table.  That is the lineage cut: a lost executor recomputes at most
one layer, never the chain from the raw feeds, and each dataset with several
consumers is computed exactly once.  Checks then read the written layers.

The output root defaults to the shared folder the cluster names in
``spark.checkpoint.dir`` (a per-session scratch folder only when unset).
"""

from __future__ import annotations

import os
import threading
import time
import uuid
from collections.abc import Collection
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.plans.warehouse import Warehouse, layer_of, passing_datasets, written_datasets
from ledgerlark.session import checkpoint_dir, shuffle_files_freed

CONCURRENT_JOBS = int(os.environ.get("LEDGERLARK_CONCURRENT_JOBS", "8"))
# A job that reads more than this fills the cores alone: such jobs run one after the other, so the disk
# holds the shuffle files of one of them.
LARGE_JOB_BYTES = 256 << 20
UNKNOWN_SIZE = (1 << 63) - 1   # what Spark takes rows for that come from no file
# A mart partitioned on write whose rows come from a table larger than this is written in several jobs, each of them some of
# the dates: the disk holds the shuffle files of one of these jobs.
SLICE_BYTES = 2 << 30
# marts partitioned by date on write (partition pruning for date-range readers).  The
# rows are rebalanced on the date: AQE merges small days and splits a large one into
# several tasks by its size.
PARTITION_BY = {"fct_llm_requests": "request_date"}
#: Written dataset with the same dates, row by row.
DATES_OF = {"fct_llm_requests": "stg_llm_requests"}
#: Codec of the written tables: smaller than the default, for the same results.
CODEC = "zstd"
# Datasets whose row count is bounded by fixed domains (calendar days / weeks x catalogue
# models, intents or metric names), not by event volume: their few rows are shuffled into
# one partition before the write (``repartition``, not ``coalesce``, so the stage that
# computes them keeps its parallelism) and land as one file instead of one per task.
DOMAIN_BOUNDED = {
    "int_daily_product_metrics", "dim_models", "dim_intents", "fct_daily_product_metrics",
    "fct_daily_model_costs", "mart_model_reliability_daily", "mart_intent_quality",
    "mart_daily_anomalies", "fct_weekly_cohort_retention",
}


@dataclass
class PipelineRun:
    """One run: ``root`` is the warehouse folder, ``folder`` this run's version below it."""

    root: str
    run_id: str = field(default_factory=lambda: f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}")
    timings: dict[str, float] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)   # what it has written so far
    passed: set[str] = field(default_factory=set)                # of these, what it has deleted after the last reader

    @property
    def folder(self) -> str:
        return f"{self.root}/runs/{self.run_id}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{layer_of(name)}/{name}"


def scanned_bytes(df: DataFrame) -> int:
    """Size of what the plan's leaves read: files count whole, rows that Spark knows no size of do not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_SIZE)


def date_slices(dates: DataFrame, part: str, n: int) -> list[Column]:
    """Conditions on ``part`` that share the rows of ``dates`` out to ``n`` ranges of about equal size, null in the first."""
    counts = dates.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(part).asc_nulls_first()).collect()
    total, so_far, cuts = sum(r.n for r in counts), 0, []
    for r in counts:
        if r[part] is not None and so_far * n >= total * (len(cuts) + 1):
            cuts.append(r[part])
        so_far += r.n
    column = F.col(part)
    starts = [F.lit(True), *[F.coalesce(column >= F.lit(c), F.lit(False)) for c in cuts]]
    return [start & ~end for start, end in zip(starts, [*starts[1:], F.lit(False)], strict=True)]


def _write(df: DataFrame, name: str, path: str, dates: DataFrame | None = None) -> float:
    """Write a dataset; ``dates`` holds the date of every row of one that is written in slices."""
    t0 = time.time()
    if name in PARTITION_BY:
        part = PARTITION_BY[name]
        n = -(-scanned_bytes(dates) // SLICE_BYTES) if dates is not None else 1
        for i, rows in enumerate(date_slices(dates, part, n) if n > 1 else [None]):
            sliced = df if rows is None else df.where(rows)
            sliced.hint("rebalance", F.col(part)).write.mode("append" if i else "overwrite").option(
                "compression", CODEC).partitionBy(part).parquet(path)
    else:
        (df.repartition(1) if name in DOMAIN_BOUNDED else df).write.mode("overwrite").option("compression", CODEC).parquet(path)
    return time.time() - t0


def one_large_at_a_time(lock: threading.Lock, df: DataFrame, fn, *args):
    """Run ``fn``, the job of ``df``; one that reads much waits for the other such jobs of the run."""
    if scanned_bytes(df) <= LARGE_JOB_BYTES:
        return fn(*args)
    with lock:
        return fn(*args)


def in_own_pool(spark, name: str, fn, *args):
    """Run ``fn`` in a scheduler pool of its own: with FAIR scheduling the jobs of a wave share the cores."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    try:
        return fn(*args)
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def materialize(wh: Warehouse, root: str | None = None, names: Collection[str] | None = None,
                concurrent_jobs: int = CONCURRENT_JOBS, publish: bool = True, run: PipelineRun | None = None) -> PipelineRun:
    """Write what the DAG shares and the marts (or those of ``names``) and rewire ``wh`` onto them.

    A dataset is written once all written datasets it reads are there: its plan is built
    in the calling thread, its job runs beside the others that are ready.  The files go to a
    folder of this run; ``publish`` makes it the version that readers see.  An earlier ``run`` of
    ``wh`` goes on: what it has written is read, the rest of ``names`` is added to it.

    The disk holds the shuffle files of jobs that are running, of one large one at most, and of the tables that
    only other written tables read (``passing_datasets``) those with a reader that is not written yet.
    """
    if run is None:
        run = PipelineRun(root or f"{checkpoint_dir(wh.spark)}/ledgerlark-{uuid.uuid4().hex[:12]}")
    wh.forget_plans()
    wh.__dict__.update(run.tables)
    waiting = written_datasets()
    if names is not None:
        waiting = {n: {d for d in needs if d in names} for n, needs in waiting.items() if n in names}
    waiting = {n: needs - run.tables.keys() for n, needs in waiting.items() if n not in run.tables}
    running: dict = {}
    passing = passing_datasets()
    large = threading.Lock()
    with shuffle_files_freed(wh.spark), ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        while waiting or running:
            for n in [n for n, needs in waiting.items() if not needs]:
                del waiting[n]
                plan = getattr(wh, n)
                dates = wh.dataset(DATES_OF[n]).select(PARTITION_BY[n]) if n in PARTITION_BY else None
                running[pool.submit(in_own_pool, wh.spark, n, one_large_at_a_time, large, plan, _write, plan, n, run.path(n), dates)] = n, plan.columns
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                n, columns = running.pop(future)
                run.timings[n] = future.result()
                run.tables[n] = wh.spark.read.parquet(run.path(n)).select(*columns)
                wh.__dict__[n] = run.tables[n]   # downstream plans read the written table
                for needs in waiting.values():
                    needs.discard(n)
            gone = [n for n, readers in passing.items() if n in run.tables and n not in run.passed and readers <= run.tables.keys()]
            for n in gone:
                del wh.__dict__[n]
            for n in gone:
                run.tables[n] = getattr(wh, n)   # whoever still asks for it has it derived again
                run.passed.add(n)
                delete_folder(wh.spark, run.path(n))
    if publish:
        publish_run(wh.spark, run)
    return run


def write_check_suite(wh: Warehouse, path: str, concurrent_jobs: int = CONCURRENT_JOBS) -> DataFrame:
    """Q09 on the written layers: the declared checks by dataset, and the SQL invariants."""
    from ledgerlark.operators.checks import DECLARED
    from ledgerlark.operators.invariants import sql_check_results

    return write_checks(wh, DECLARED, path, {"sql_checks": sql_check_results(wh.sql_checks)}, concurrent_jobs)


def write_checks(wh: Warehouse, checks: list, path: str, more: dict[str, DataFrame] | None = None,
                 concurrent_jobs: int = CONCURRENT_JOBS) -> DataFrame:
    """Declared checks on the written layers: one small job per dataset (and one for each part of ``more``),
    run concurrently, each appending its rows to the audit table - never one giant plan, whose shuffle
    files would all be on the disk at its end."""
    from ledgerlark.operators.checks import run_checks

    parts: dict[str, DataFrame] = {}
    for ds in dict.fromkeys(c.dataset for c in checks):
        group = [c for c in checks if c.dataset == ds]
        needed = {ds} | {c.parent[0] for c in group if c.parent}
        parts[ds] = run_checks({n: wh.dataset(n) for n in needed}, group)
    parts |= more or {}
    large = threading.Lock()

    def write(item):
        name, df = item
        # at most one row per check, and every part ends in a post-exchange aggregate:
        # one file per dataset without an extra shuffle
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/part={name}")

    with shuffle_files_freed(wh.spark), ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        list(pool.map(lambda item: in_own_pool(wh.spark, item[0], one_large_at_a_time, large, item[1], write, item), parts.items()))
    return wh.spark.read.parquet(path).drop("part")


def run_pipeline(wh: Warehouse, root: str | None = None, with_checks: bool = True) -> tuple[PipelineRun, DataFrame | None]:
    """S11 - build every layer in dependency order, then run the check suite on the written layers."""
    run = materialize(wh, root)
    if not with_checks:
        return run, None
    t0 = time.time()
    suite = write_check_suite(wh, f"{run.folder}/audit/check_suite")
    run.timings["check_suite"] = time.time() - t0
    return run, suite


def delete_folder(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Versions ------------------------------------------------------------------------
POINTER = "CURRENT"


def _file_context(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()), p


def replace_pointer(spark, path: str, text: str) -> None:
    """Write a small file and put it in place of ``path`` by one rename."""
    jvm = spark._jvm
    fc, pointer = _file_context(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fc.create(draft, jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE),
                    _java_array(spark, jvm.org.apache.hadoop.fs.Options.CreateOpts, jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()))
    out.writeBytes(text)
    out.close()
    fc.rename(draft, pointer, _java_array(spark, jvm.org.apache.hadoop.fs.Options.Rename, jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE))


def read_pointer(spark, path: str) -> str | None:
    """Content of a pointer file, None if there is none."""
    fc, pointer = _file_context(spark, path)
    if not fc.util().exists(pointer):
        return None
    stream = fc.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_run(spark, run: PipelineRun) -> None:
    """Make a run the current version: one small file, replaced by one rename.

    A reader sees the old version or the new one, whole; the old run's files stay until
    ``expire_runs``.
    """
    replace_pointer(spark, f"{run.root}/{POINTER}", run.run_id)


def _java_array(spark, cls, *items):
    out = spark.sparkContext._gateway.new_array(cls, len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out


def current_run(spark, root: str) -> str:
    """Id of the published run."""
    run = read_pointer(spark, f"{root}/{POINTER}")
    if run is None:
        raise FileNotFoundError(f"no run is published below {root}")
    return run


def expire_runs(spark, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest runs and the current one; returns what went.

    Plans made on a version read its files until they end, so ``keep`` covers the longest reader.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    runs = sorted(f.getPath().getName() for f in fs.listStatus(base))
    current = current_run(spark, root)
    gone = [r for r in runs[:max(0, len(runs) - keep)] if r != current]
    for r in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(base, r), True)
    return gone


def read_mart(spark, root: str, name: str) -> DataFrame:
    """S09 - consumers read published marts only, all of the version current at the call."""
    return read_marts(spark, root, name)[name]


def read_marts(spark, root: str, *names: str) -> dict[str, DataFrame]:
    """Several marts of one and the same version."""
    run = current_run(spark, root)
    return {n: spark.read.parquet(f"{root}/runs/{run}/marts/{n}") for n in names}
