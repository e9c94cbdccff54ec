"""Streaming micro-batches reproduce batch staging exactly (replays split across batches)."""
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.staging import stg_llm_requests
from ledgerlark.sources import seeds
from ledgerlark.sources.feeds import derive_feeds
from ledgerlark.sources.landing import write_csv
from ledgerlark.streaming import incremental
from ledgerlark.streaming.incremental import expire_state, live_folders, merge_batch, staged_requests, start_incremental_staging


def test_incremental_equals_batch(spark, tmp_path):
    raw = derive_feeds(spark, "/root/testdata/sf0.001")["llm_requests"].cache()
    landing = str(tmp_path / "landing")
    # batch 1: first copies only; batch 2: everything else, incl. the later replay copies
    first = raw.groupBy("request_id").agg(F.min("_ingested_at").alias("_ingested_at"))
    b1 = raw.join(first, ["request_id", "_ingested_at"], "left_semi")
    b2 = raw.join(first, ["request_id", "_ingested_at"], "left_anti")
    b1, b2 = b1.select(*raw.columns), b2.select(*raw.columns)
    write_csv(b1.coalesce(2), f"{landing}/part1")
    write_csv(b2.coalesce(1), f"{landing}/part2")
    state = str(tmp_path / "state")
    q = start_incremental_staging(spark, f"{landing}/*", state, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(600)
    assert q.lastProgress is not None
    inc = staged_requests(spark, state, seeds.model_aliases(spark))
    batch = stg_llm_requests(raw, seeds.model_aliases(spark))
    assert inc.count() == batch.count()
    cols = batch.columns
    assert inc.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert inc.where("had_duplicate_ingest").count() == 8


def test_null_dates_replays_on_other_dates_and_retries(spark, tmp_path):
    raw = derive_feeds(spark, "/root/testdata/sf0.001")["llm_requests"].limit(40).cache()
    ids = [r.request_id for r in raw.select("request_id").distinct().orderBy("request_id").limit(4).collect()]
    no_date = raw.withColumn("created_at", F.when(F.col("request_id").isin(ids[:2]), F.lit("")).otherwise(F.col("created_at")))
    replay = no_date.where(F.col("request_id").isin(ids[1:])).withColumn("created_at", F.lit("2024-02-01 00:00:00")).withColumn(
        "_ingested_at", F.lit("2024-02-02 00:00:00"))
    state, aliases = str(tmp_path / "state"), seeds.model_aliases(spark)
    for batch_id, batch in enumerate((no_date, replay, replay.limit(0))):
        merge_batch(batch, state, batch_id)
    merge_batch(replay, state, 1)   # the sink failed and runs again
    expected = stg_llm_requests(no_date.unionByName(replay), aliases)
    got = staged_requests(spark, state, aliases).select(*expected.columns)
    assert got.count() == expected.count() == got.select("request_id").distinct().count()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert got.where("request_date is null").count() >= 1


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fifty_batches_stay_bounded_and_folds_survive_a_crash(spark, tmp_path, monkeypatch):
    raw = derive_feeds(spark, "/root/testdata/sf0.001")["llm_requests"].limit(150).cache()
    state, aliases = str(tmp_path / "state"), seeds.model_aliases(spark)
    raw = raw.unionByName(raw.limit(20)).withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(50))).cache()
    expected = stg_llm_requests(raw.drop("part"), aliases).cache()

    def batch(i):
        return raw.where(F.col("part") == i).drop("part").coalesce(1)

    for i in range(49):
        merge_batch(batch(i), state, i, fold_after=4)
        assert len(live_folders(spark, state)) <= 3 * 3   # below four folders on each of three levels
    publish, calls = incremental._publish, []

    def crash_at_the_swap(spark, path, entries):
        calls.append(entries)
        if len(calls) > 1:
            raise OSError("lost before the swap")
        publish(spark, path, entries)

    # The last batch is live, its fold is written, and the driver dies before the manifest names the fold.
    monkeypatch.setattr(incremental, "_publish", crash_at_the_swap)
    try:
        merge_batch(batch(49), state, 49, fold_after=2)
    except OSError:
        pass
    assert len(calls) == 2
    monkeypatch.undo()
    assert same(staged_requests(spark, state, aliases), expected)
    merge_batch(batch(49), state, 49, fold_after=4)   # the stream runs the batch again
    merge_batch(batch(3), state, 3, fold_after=4)     # a batch that a fold holds
    assert same(staged_requests(spark, state, aliases), expected)
    assert expire_state(spark, state) and expire_state(spark, state) == []
    assert same(staged_requests(spark, state, aliases), expected)


def test_the_stream_folds_and_stops_at_unbalanced_quotes(spark, tmp_path):
    raw = derive_feeds(spark, "/root/testdata/sf0.001")["llm_requests"].limit(60).cache()
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    write_csv(raw.repartition(5), f"{landing}/a")

    def run():
        q = start_incremental_staging(spark, f"{landing}/*", state, str(tmp_path / "ckpt"), max_files_per_trigger=1, fold_after=2)
        q.awaitTermination(600)

    run()
    assert len(live_folders(spark, state)) <= 3
    aliases = seeds.model_aliases(spark)
    assert same(staged_requests(spark, state, aliases), stg_llm_requests(raw, aliases))
    bad = tmp_path / "landing" / "b"
    bad.mkdir()
    (bad / "bad.csv").write_text(",".join(raw.columns) + "\n" + ",".join(["x"] * (len(raw.columns) - 1)) + ',"x\n')
    with pytest.raises(Exception, match="unbalanced quote in .*bad.csv"):
        run()
    assert same(staged_requests(spark, state, aliases), stg_llm_requests(raw, aliases))
