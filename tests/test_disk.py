"""What a run, the checks and the stream leave on the disk, and that their rows stay whole."""
import os
import time

from pyspark.sql import functions as F

from ledgerlark.operators.checks import DECLARED, run_checks
from ledgerlark.plans import pipeline, registry
from ledgerlark.plans.pipeline import _write, date_slices, materialize, write_checks
from ledgerlark.plans.warehouse import Warehouse, passing_datasets
from test_pipeline import _driver_tables


def _same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_a_run_keeps_no_shuffle_files_and_no_table_after_its_last_reader(spark, tmp_path):
    src = str(tmp_path / "in")
    _driver_tables(spark, src)
    wh, lazy = Warehouse.from_driver_tables(spark, src), Warehouse.from_driver_tables(spark, src)
    before = _shuffle_files(spark)
    run = materialize(wh, str(tmp_path / "wh"), names=registry.STAGED_REQUESTS)
    end = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < end:   # they go in the background
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert run.passed == {"typed_requests", "request_replays"} and not any(os.path.exists(run.path(n)) for n in run.passed)
    assert _same(wh.stg_llm_requests, lazy.stg_llm_requests) and _same(wh.typed_requests, lazy.typed_requests)
    assert passing_datasets().keys() == {"typed_requests", "request_replays", "conversation_facts"}
    again = materialize(wh, names=[*registry.STAGED_REQUESTS, "dim_models"], run=run)
    assert _same(wh.dim_models, lazy.dim_models) and again.passed == run.passed


def test_slices_of_dates_hold_every_row_once(spark, tmp_path, monkeypatch):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 11).cast("int"))
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, day).alias("request_date"))
    for n in (1, 2, 5, 50):
        parts = date_slices(df, "request_date", n)
        counts = [df.where(p).count() for p in parts]
        assert sum(counts) == 3000 and 1 <= len(parts) <= min(n, 12) and (n != 5 or (len(parts) == 5 and max(counts) < 1200))
    monkeypatch.setattr(pipeline, "SLICE_BYTES", 8000)
    jobs, write = [], pipeline.date_slices
    monkeypatch.setattr(pipeline, "date_slices", lambda *a: jobs.append(write(*a)) or jobs[-1])
    _write(df, "fct_llm_requests", str(tmp_path / "out"), df.select("request_date"))
    assert len(jobs) == 1 and len(jobs[0]) == 3
    assert _same(spark.read.parquet(str(tmp_path / "out")), df)
    _write(df.limit(0), "fct_llm_requests", str(tmp_path / "none"), df.limit(0).select("request_date"))


def test_checks_of_one_kind_are_written_dataset_by_dataset(spark, tmp_path):
    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    checks = [c for c in DECLARED if c.kind == "relationships" and c.dataset in ("raw_conversations", "stg_conversations", "stg_escalations")]
    got = write_checks(wh, checks, str(tmp_path / "audit"))
    names = {c.dataset for c in checks} | {c.parent[0] for c in checks}
    assert _same(got, run_checks({n: wh.dataset(n) for n in names}, checks)) and got.count() == 3
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_requests_travel_to_their_conversations_without_derived_columns(spark):
    from ledgerlark.operators.staging import BASE_COLUMNS

    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    left, todo = [], [wh.fct_llm_requests._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join" and "_right" in node.condition().toString():
            out = node.left().output()
            left.append({out.apply(i).name() for i in range(out.size())})
    assert left == [{*BASE_COLUMNS, "_key"}]


def test_the_stream_keeps_only_live_folders_of_a_state_that_nobody_reads_yet(spark, tmp_path):
    from ledgerlark.operators.staging import stg_llm_requests
    from ledgerlark.sources import seeds
    from ledgerlark.sources.feeds import derive_feeds
    from ledgerlark.sources.landing import write_csv
    from ledgerlark.streaming.incremental import live_folders, staged_requests, start_incremental_staging, write_replayed

    raw = derive_feeds(spark, "/root/testdata/sf0.001")["llm_requests"].where("request_id < 'r_2'").cache()
    raw = raw.unionByName(raw.limit(30)).cache()
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    write_csv(raw.repartition(3), landing, "gzip")
    assert all(f.endswith((".csv.gz", ".crc", "_SUCCESS")) for f in os.listdir(landing))
    q = start_incremental_staging(spark, landing, state, str(tmp_path / "ckpt"), max_files_per_trigger=1, attempts=2, expire=True)
    q.awaitTermination(600)
    live = {e["folder"] for e in live_folders(spark, state)}
    assert len(live) == 3 and {f for f in os.listdir(state) if os.path.isdir(f"{state}/{f}")} == live
    aliases, replayed = seeds.model_aliases(spark), write_replayed(spark, state, str(tmp_path / "replayed"))
    assert _same(staged_requests(spark, state, aliases, replayed), stg_llm_requests(raw, aliases))
