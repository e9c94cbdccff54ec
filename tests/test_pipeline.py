"""End to end on the smallest fixture: written layers, the 170-check suite, X01/X02."""
from pyspark.sql import functions as F

from ledgerlark.operators.checks import DECLARED
from ledgerlark.operators.defects import inject_defects, reconcile_manifest
from ledgerlark.plans.pipeline import materialize, read_mart, run_pipeline
from ledgerlark.plans.warehouse import Warehouse
from ledgerlark.sources.feeds import derive_feeds

WARN_EXPECTED = {
    "not_null__raw_llm_requests__conversation_id", "unique__raw_llm_requests__request_id",
    "expression__raw_llm_requests__latency_non_negative", "expression__raw_llm_requests__token_sum",
    "warn_conflicting_resolution", "warn_unreconciled_costs",
}


def test_suite_outcome(spark, tmp_path):
    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    run, suite = run_pipeline(wh, str(tmp_path / "wh"))
    rows = {r.check_name: r for r in suite.collect()}
    assert len(rows) == len(DECLARED) + 10 == 170
    assert {n for n, r in rows.items() if r.status == "warn"} == WARN_EXPECTED
    # the 2 % cost SLO is documented to fail on this tiny fixture's low-volume days only
    assert {n for n, r in rows.items() if r.status == "error"} <= {"check_cost_mismatch_slo"}
    # no fan-out: one row per request / conversation from staging to marts
    assert wh.fct_llm_requests.count() == wh.stg_llm_requests.select("request_id").distinct().count()
    assert wh.fct_conversations.count() == wh.stg_conversations.count()


def test_injected_defects_are_all_detected(spark):
    clean = derive_feeds(spark, "/root/testdata/sf0.001", clean=True)
    messy, manifest = inject_defects(clean)
    wh = Warehouse(spark, messy)
    rec = reconcile_manifest(manifest, wh)
    tot = rec.agg(F.sum("expected").alias("e"), F.sum("detected").alias("d"), F.sum("missed").alias("m"),
                  F.sum("extra").alias("x")).first()
    assert tot.e > 0 and tot.d == tot.e and tot.m == 0 and tot.x == 0


def test_written_layers_equal_lazy_plans_with_duplicates(spark, tmp_path):
    """A duplicated hand-off and a duplicated price row repeat rows of joins, never of staging."""
    feeds = derive_feeds(spark, "/root/testdata/sf0.001")
    twice = {**feeds, "escalations": feeds["escalations"].unionByName(feeds["escalations"].limit(1)),
             "daily_model_prices": feeds["daily_model_prices"].unionByName(feeds["daily_model_prices"].limit(1))}
    twice = {n: df.cache() for n, df in twice.items()}
    names = ["stg_conversations", "stg_llm_requests", "dim_intents", "fct_llm_requests", "int_conversation_quality", "fct_conversations"]

    def sizes(wh):
        return {n: (getattr(wh, n).count() if n != "dim_intents" else wh.dim_intents.agg(F.sum("n_conversations")).first()[0]) for n in names}

    lazy = sizes(Warehouse(spark, twice))
    wh = Warehouse(spark, twice)
    materialize(wh, str(tmp_path / "wh"))
    assert sizes(wh) == lazy
    assert lazy["stg_conversations"] == lazy["dim_intents"] == lazy["fct_conversations"] - 1
    assert read_mart(spark, str(tmp_path / "wh"), "dim_models").count() == 5


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """One request date for all rows: the rebalanced write splits it by size."""
    import os

    from ledgerlark.plans.pipeline import _write

    df = spark.range(400_000).select(F.col("id").alias("request_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                     F.lit("2024-01-01").cast("date").alias("request_date"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        _write(df, "fct_llm_requests", str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    parts = [f for f in os.listdir(tmp_path / "out" / "request_date=2024-01-01") if f.endswith(".parquet")]
    assert len(parts) > 2 and spark.read.parquet(str(tmp_path / "out")).count() == 400_000


def test_no_escalated_conversation(spark):
    """X01 marks nothing when nobody was escalated."""
    from ledgerlark.operators.defects import inject_conversation_defects

    c = derive_feeds(spark, "/root/testdata/sf0.001", clean=True)["conversations"].withColumn("escalated", F.lit("False"))
    messy, manifest = inject_conversation_defects(c)
    assert manifest.count() == 0 and messy.exceptAll(c).count() == 0


def test_new_input_files_start_a_new_run(spark, tmp_path):
    import shutil

    from ledgerlark.plans import registry

    src = tmp_path / "in"
    src.mkdir()
    for t in ("customer", "nation", "orders", "lineitem"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", src / f"{t}.parquet")
    first = registry.materialized_warehouse(spark, str(src))
    assert registry.materialized_warehouse(spark, str(src)) is first
    n = first.dim_users.count()
    spark.read.parquet(str(src / "customer.parquet")).limit(100).coalesce(1).write.parquet(str(tmp_path / "less"))
    (src / "customer.parquet").unlink()
    shutil.copy(next((tmp_path / "less").glob("part-*.parquet")), src / "customer.parquet")
    again = registry.materialized_warehouse(spark, str(src))
    assert again is not first and again.dim_users.count() == 100 < n
    registry.release_materialized(spark)
    assert not any(k[1] == str(src) for k in registry._MATERIALIZED)


def _driver_tables(spark, root):
    """Forty users, one order a user and day of ten, two requests an order."""
    tables = {
        "nation": spark.range(3).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name", "0 AS n_regionkey"),
        "customer": spark.range(40).selectExpr(
            "id + 1 AS c_custkey", "concat('c', id) AS c_name", "cast(id % 3 AS int) AS c_nationkey", "1.0D AS c_acctbal", "'BUILDING' AS c_mktsegment"),
        "orders": spark.range(400).selectExpr(
            "id + 1 AS o_orderkey", "id % 40 + 1 AS o_custkey", "'O' AS o_orderstatus", "9.0D AS o_totalprice",
            "timestamp '1995-01-01 00:00:00' + make_interval(0, 0, 0, cast(id DIV 40 AS int)) AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": spark.range(800).selectExpr(
            "id DIV 2 + 1 AS l_orderkey", "id * 7 % 50 + 1 AS l_partkey", "id * 3 % 11 + 1 AS l_suppkey", "cast(id % 2 + 1 AS int) AS l_linenumber",
            "cast(id % 30 + 1 AS double) AS l_quantity", "cast(id % 900 + 10 AS double) AS l_extendedprice", "0.0D AS l_discount", "0.0D AS l_tax",
            "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp '1995-02-01 00:00:00' AS l_shipdate"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")


def test_a_query_writes_its_own_lineage_and_the_next_goes_on_with_the_run(spark, tmp_path):
    """A report of the cohorts writes no request; a check that reads more adds to the same run and rewrites nothing."""
    import os

    from ledgerlark.plans import registry, reports
    from ledgerlark.plans.warehouse import written_for

    src = str(tmp_path / "in")
    _driver_tables(spark, src)
    query, key = registry.spark_queries(), (spark.sparkContext.applicationId, src, ())
    lazy = Warehouse.from_driver_tables(spark, src)
    try:
        grid = query["report_cohort_grid"](spark, src)
        run = registry._MATERIALIZED[key][2]
        assert set(run.tables) == {"stg_users", "stg_conversations", "fct_weekly_cohort_retention"}
        expected = registry.publish(reports.cohort_grid(lazy.fct_weekly_cohort_retention))
        assert grid.count() == expected.count() > 0 and grid.exceptAll(expected).count() == 0
        files = {n: sorted(os.listdir(run.path(n))) for n in run.tables}
        assert query["check_cohort_sizes"](spark, src).count() == 0
        assert registry._MATERIALIZED[key][2] is run and set(run.tables) == written_for(("fct_weekly_cohort_retention", "dim_users"))
        assert {n: sorted(os.listdir(run.path(n))) for n in files} == files
        ledger = query["check_conversation_cost_ledger"](spark, src)
        assert ledger.count() == 0 and run.tables["fct_llm_requests"].count() == lazy.fct_llm_requests.count() > 0
    finally:
        registry.release_materialized(spark)
