"""Registry of named queries: the Spark implementation and its DuckDB oracle.

``SPARK[name]`` maps a :class:`Warehouse` to a DataFrame; ``ORACLE[name]`` is the
final SELECT of the independent DuckDB formulation (CTEs are added by
``oracle.sql.build``).  Output columns with a DECIMAL type are published as
DOUBLE on both sides of the comparison (``DECIMAL_COLUMNS``), so the two
engines' result hashes do not depend on how each client renders decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerlark.oracle.marts_sql  # noqa: F401  (registers mart CTEs)
from ledgerlark.oracle.sql import build
from ledgerlark.config import WarehouseConfig
from ledgerlark.plans.pipeline import PipelineRun, materialize
from ledgerlark.plans.warehouse import MART_NAMES, Warehouse, written_datasets, written_for

SPARK: dict[str, Callable[[Warehouse], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Query on written layers -> the datasets it reads (None: all).
ON_WRITTEN_LAYERS: dict[str, tuple[str, ...] | None] = {}
ON_STAGED_REQUESTS: set[str] = set()
ON_TYPED_REQUESTS: set[str] = set()

# Newest event of each derived feed: stands for its load time, and the newest
# ingestion of a request for the time of the check, so ages follow the tables.
FEED_EVENT_TIME = {
    "users": "created_at", "conversations": "ended_at", "llm_requests": "_ingested_at",
    "intent_predictions": "created_at", "escalations": "created_at", "daily_model_prices": "price_date",
}


def register(name: str, oracle: str | None, written_layers: bool = False, staged_requests: bool = False, typed_requests: bool = False,
             reads: tuple[str, ...] | None = None):
    """Add a query; ``written_layers`` runs it on the materialised (written) layers, those behind the datasets it ``reads`` (None: all).

    ``staged_requests``: its plan reads the requests several times, so they are staged and written once.
    ``typed_requests``: it reads the staged requests once, which reads the typed rows three times: those are written.
    """
    def deco(fn: Callable[[Warehouse], DataFrame]):
        SPARK[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        if written_layers:
            ON_WRITTEN_LAYERS[name] = reads
        if staged_requests:
            ON_STAGED_REQUESTS.add(name)
        if typed_requests:
            ON_TYPED_REQUESTS.add(name)
        return fn
    return deco


_MATERIALIZED: dict[tuple[str, str, tuple[str, ...]], tuple[tuple, Warehouse, PipelineRun]] = {}
#: What the queries of ``ON_TYPED_REQUESTS`` write: the typed requests and the hashes of the replayed ones.
TYPED_REQUESTS = ("typed_requests", "request_replays")
#: What the queries of ``ON_STAGED_REQUESTS`` write: the staged requests and what they wait for.
STAGED_REQUESTS = (*TYPED_REQUESTS, "stg_llm_requests")


def _input_files(spark: SparkSession, sf_dir: str) -> tuple:
    """(name, size, modification time) of the input files, through Spark's own file system."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(conf).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def _delete(spark: SparkSession, root: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialized_warehouse(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = (),
                           reads: tuple[str, ...] | None = None) -> Warehouse:
    """One pipeline run (of all layers, or of ``names``) per application and state of the input files.

    A run of all layers is made as far as the queries need it: ``reads`` has written what lies behind these
    datasets (None: everything), and a later call goes on with the same run.  New files under the same path
    start a new run; the layers of the old one are deleted.
    """
    key, files = (spark.sparkContext.applicationId, sf_dir, names), _input_files(spark, sf_dir)
    old = _MATERIALIZED.get(key)
    if old and old[0] != files:
        _delete(spark, _MATERIALIZED.pop(key)[2].root)
        old = None
    wanted = set(names) or (None if reads is None else written_for(reads))
    wh, run = old[1:] if old else (Warehouse.from_driver_tables(spark, sf_dir), None)
    if run is None or not (written_datasets().keys() if wanted is None else wanted) <= run.tables.keys():
        _MATERIALIZED[key] = (files, wh, materialize(wh, names=wanted, run=run))
    return wh


def release_materialized(spark: SparkSession) -> None:
    """Delete the written layers of this application's runs."""
    for key in [k for k in _MATERIALIZED if k[0] == spark.sparkContext.applicationId]:
        _delete(spark, _MATERIALIZED.pop(key)[2].root)


def publish(df: DataFrame) -> DataFrame:
    """Cast DECIMAL output columns to DOUBLE (comparison-friendly publication)."""
    cols = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _dataset(name: str, oracle_cte: str, staged_requests: bool = False, typed_requests: bool = False) -> None:
    register(name, f"SELECT * FROM {oracle_cte}", staged_requests=staged_requests, typed_requests=typed_requests)(lambda wh, n=name: getattr(wh, n))


# staging (M01-M05; M06 is a rule-generated price sheet, not registered alone)
_dataset("stg_users", "s_users")
_dataset("stg_conversations", "s_conversations")
_dataset("stg_llm_requests", "s_llm_requests")
_dataset("stg_intent_predictions", "s_intent_predictions")
_dataset("stg_escalations", "s_escalations")
# intermediate
_dataset("int_model_costs", "i_model_costs_view")
_dataset("int_conversation_request_rollup", "i_rollup", typed_requests=True)
_dataset("int_conversation_quality", "i_quality")
_dataset("int_daily_product_metrics", "i_daily", typed_requests=True)
_dataset("int_intent_confusion", "i_confusion")
# marts (M12-M18, M20, M21)
_dataset("dim_users", "m_dim_users", typed_requests=True)
_dataset("dim_models", "m_dim_models")
_dataset("dim_intents", "m_dim_intents")
_dataset("fct_conversations", "m_fct_conversations", typed_requests=True)
_dataset("fct_llm_requests", "m_fct_llm_requests", typed_requests=True)
_dataset("fct_daily_product_metrics", "m_fct_daily", typed_requests=True)
_dataset("fct_daily_model_costs", "m_fct_daily_model_costs")
_dataset("mart_intent_quality", "m_intent_quality", typed_requests=True)
_dataset("mart_model_reliability_daily", "m_reliability", staged_requests=True)
_dataset("fct_weekly_cohort_retention", "m_retention")
_dataset("mart_daily_anomalies", "m_anomalies", typed_requests=True)


# data quality (Q01-Q07 per kind, Q09 suite, Q10-Q19 invariants)
CHECK_KINDS = {
    "check_unique": "unique", "check_not_null": "not_null", "check_accepted_values": "accepted_values",
    "check_relationships": "relationships", "check_accepted_range": "accepted_range",
    "check_expression_is_true": "expression", "check_unique_combination": "combination",
}


def _register_checks() -> None:
    import uuid

    from ledgerlark.operators.checks import DECLARED
    from ledgerlark.operators.invariants import SQL_CHECK_INPUTS, SQL_CHECKS, sql_check_frame
    from ledgerlark.oracle.checks_sql import SQL_CHECK_CTE, declared_suite_sql, sql_suite_sql
    from ledgerlark.plans.pipeline import write_check_suite, write_checks
    from ledgerlark.session import checkpoint_dir

    def audit_folder(wh: Warehouse) -> str:
        return f"{checkpoint_dir(wh.spark)}/check-suite-{uuid.uuid4().hex[:12]}"

    for qname, kind in CHECK_KINDS.items():
        checks = [c for c in DECLARED if c.kind == kind]
        names = tuple(sorted({c.dataset for c in checks} | {c.parent[0] for c in checks if c.parent}))
        register(qname, declared_suite_sql(kind), True, reads=names)(
            lambda wh, checks=checks: write_checks(wh, checks, audit_folder(wh)))

    register("check_suite", f"{declared_suite_sql()}\nUNION ALL\n{sql_suite_sql()}", True)(
        lambda wh: write_check_suite(wh, audit_folder(wh)))
    for name, _sev in SQL_CHECKS:
        register(name, f"SELECT * FROM {SQL_CHECK_CTE[name]}", True, reads=SQL_CHECK_INPUTS[name][1])(
            lambda wh, n=name: sql_check_frame(wh, n))


def _register_landing() -> None:
    from ledgerlark.operators.invariants import source_freshness
    from ledgerlark.sources.landing import landing_counts

    counts_sql = "\nUNION ALL\n".join(
        f"SELECT 'raw_{n}' AS table_name, count(*) AS n_rows FROM raw_{n}"
        for n in ("users", "conversations", "llm_requests", "intent_predictions", "escalations", "daily_model_prices"))
    register("landing_counts", counts_sql)(lambda wh: landing_counts(wh.feeds))
    register("landed_counts", counts_sql)(lambda wh: landed_counts(wh))
    hours = f"(epoch((SELECT max(cast(_ingested_at AS timestamp)) FROM raw_llm_requests)) - epoch(newest)) / 3600.0"
    cfg = WarehouseConfig()
    fresh_sql = "\nUNION ALL\n".join(
        f"SELECT 'raw_{n}' AS table_name, newest AS max_loaded_at, {hours} AS age_hours, "
        f"CASE WHEN newest IS NULL OR {hours} > {cfg.freshness_error_hours} THEN 'error' "
        f"WHEN {hours} > {cfg.freshness_warn_hours} THEN 'warn' ELSE 'pass' END AS status "
        f"FROM (SELECT max(cast({c} AS timestamp)) AS newest FROM raw_{n}) x"
        for n, c in FEED_EVENT_TIME.items())

    def freshness(wh: Warehouse) -> DataFrame:
        now = wh.feeds["llm_requests"].agg(F.max(F.col("_ingested_at").cast("timestamp")).alias("as_of"))
        stamped = {f"raw_{n}": wh.feeds[n].withColumn("_loaded_at", F.col(c).cast("timestamp")) for n, c in FEED_EVENT_TIME.items()}
        return source_freshness(stamped, now, wh.config.freshness_warn_hours, wh.config.freshness_error_hours)

    register("freshness", fresh_sql)(freshness)


_register_landing()


def incident_window(cfg: WarehouseConfig) -> tuple[str, str]:
    """The analysis window of R21: the incident day and one day either side."""
    import datetime as dt

    d = dt.date.fromisoformat(cfg.incident_date)
    return str(d - dt.timedelta(days=1)), str(d + dt.timedelta(days=1))


def _register_reports() -> None:
    from ledgerlark.oracle.reports_sql import REPORTS
    from ledgerlark.plans import reports as R

    spark_side = {
        "report_kpi_series": (R.kpi_series, "fct_daily_product_metrics"),
        "report_headline_tiles": (R.headline_tiles, "fct_daily_product_metrics"),
        "report_daily_model_costs": (R.daily_model_costs, "fct_daily_model_costs"),
        "report_cost_by_model": (R.cost_by_model, "fct_daily_model_costs"),
        "report_reliability": (R.reliability, "mart_model_reliability_daily"),
        "report_failures_by_status": (R.failures_by_status, "mart_model_reliability_daily"),
        "report_model_scorecard": (R.model_scorecard, "mart_model_reliability_daily"),
        "report_anomaly_list": (R.anomaly_list, "mart_daily_anomalies"),
        "report_metrics_flagged_per_day": (R.metrics_flagged_per_day, "mart_daily_anomalies"),
        "report_cohort_grid": (R.cohort_grid, "fct_weekly_cohort_retention"),
        "report_retention_curve": (R.retention_curve, "fct_weekly_cohort_retention"),
        "report_intent_table": (R.intent_table, "mart_intent_quality"),
        "report_conversation_cube": (R.conversation_cube, "fct_conversations"),
        "report_confidence_distribution": (R.confidence_distribution, "fct_conversations"),
        "report_escalations_top_intents": (R.escalations_top_intents, "fct_conversations"),
        "report_data_quality_summary": (R.data_quality_summary, "fct_llm_requests"),
        "report_flag_shares": (R.flag_shares, "fct_llm_requests"),
        "report_cost_drift_by_model": (R.cost_drift_by_model, "fct_daily_model_costs"),
        "report_conflicting_flags": (R.conflicting_flag_counter, "fct_conversations"),
        "report_kpi_panels": (R.kpi_panels, "fct_daily_product_metrics"),
        "report_incident_blast_radius": (
            R.incident_blast_radius, "mart_model_reliability_daily", "fct_conversations", *incident_window(WarehouseConfig())),
    }
    picked = R.ReportFilter("2024-01-20", "2024-02-25", ("gpt-4o-mini", "claude-haiku-4-5"))
    spark_side |= {
        "report_headline_tiles_filtered": (R.headline_tiles, "fct_daily_product_metrics", picked),
        "report_daily_model_costs_filtered": (R.daily_model_costs, "fct_daily_model_costs", picked),
        "report_anomaly_list_filtered": (R.anomaly_list, "mart_daily_anomalies", picked),
        "report_data_quality_summary_filtered": (R.data_quality_summary, "fct_llm_requests", picked),
    }
    for name, (report, *args) in spark_side.items():
        marts = tuple(a for a in args if a in MART_NAMES)
        register(name, REPORTS[name], True, reads=marts)(
            lambda wh, report=report, args=args: report(*(wh.dataset(a) if a in MART_NAMES else a for a in args)))


_register_reports()


def landed_counts(wh: Warehouse) -> DataFrame:
    """S01-S04 - write the derived feeds as CSV extracts, land them, count the landed rows."""
    import uuid

    from ledgerlark.session import checkpoint_dir
    from ledgerlark.sources.landing import land_feeds, landing_counts, read_feeds, write_feeds

    root = f"{checkpoint_dir(wh.spark)}/landed-{uuid.uuid4().hex[:12]}"
    write_feeds(wh.feeds, f"{root}/extracts")
    land_feeds(wh.spark, f"{root}/extracts", f"{root}/tables")
    return landing_counts(read_feeds(wh.spark, f"{root}/tables"))


#: Bytes of the driver's request tables behind one extract file (some eight times that as CSV, which one task reads: it is packed).
EXTRACT_BYTES = 2 << 20
INCREMENTAL_BATCHES = 4


def extract_files(n_bytes: int) -> int:
    """Extract files of a feed derived from ``n_bytes``: a multiple of the batches that grows with the input."""
    return INCREMENTAL_BATCHES * max(1, -(-n_bytes // (EXTRACT_BYTES * INCREMENTAL_BATCHES)))


def _table_bytes(spark: SparkSession, path: str) -> int:
    """Size of a table, a file or a folder, through Spark's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def incremental_requests(wh: Warehouse) -> DataFrame:
    """X07 - land the request feed in several files, so replays arrive in other batches than
    their originals, stage it in four batches and merge every batch twice, as a retry would.

    The files are of bounded size, so they are packed: their number grows with the request table."""
    import uuid

    from ledgerlark.session import checkpoint_dir, shuffle_files_freed
    from ledgerlark.sources.landing import FEED_COLUMNS, write_csv
    from ledgerlark.streaming.incremental import staged_requests, start_incremental_staging, write_replayed

    root = f"{checkpoint_dir(wh.spark)}/incremental-{uuid.uuid4().hex[:12]}"
    feed = wh.feeds["llm_requests"].select(*FEED_COLUMNS["llm_requests"])
    n_files = extract_files(_table_bytes(wh.spark, f"{wh.source_root}/lineitem.parquet"))
    with shuffle_files_freed(wh.spark):
        write_csv(feed.repartition(n_files, "request_id", "_ingested_at"), f"{root}/landing", "gzip")
        q = start_incremental_staging(wh.spark, f"{root}/landing", f"{root}/state", f"{root}/stream-ckpt",
                                      max_files_per_trigger=n_files // INCREMENTAL_BATCHES, attempts=2, expire=True)
        q.awaitTermination()
        replayed = write_replayed(wh.spark, f"{root}/state", f"{root}/replayed")
    return staged_requests(wh.spark, f"{root}/state", wh.model_aliases, replayed)


def _register_extensions() -> None:
    from ledgerlark.operators.defects import inject_defects, reconcile_manifest
    from ledgerlark.oracle.defects_sql import DEFECT_MANIFEST_SQL, RECONCILIATION_SQL
    from ledgerlark.sources.feeds import derive_feeds

    def injected(wh: Warehouse):
        clean = derive_feeds(wh.spark, wh.source_root, clean=True)
        return inject_defects(clean)

    def reconciliation(wh: Warehouse) -> DataFrame:
        import uuid

        from ledgerlark.session import checkpoint_dir
        from ledgerlark.sources.landing import read_manifest, write_manifest

        messy, manifest = injected(wh)
        path = f"{checkpoint_dir(wh.spark)}/manifest-{uuid.uuid4().hex[:12]}"
        write_manifest(manifest, path)
        return reconcile_manifest(read_manifest(wh.spark, path), Warehouse(wh.spark, messy, wh.config))

    from ledgerlark.operators.intermediate import price_of_day
    from ledgerlark.operators.rollups import rollup_kpis
    from ledgerlark.oracle.marts_sql import rollup_sql

    from ledgerlark.operators.anomalies import provider_anomalies
    from ledgerlark.operators.cohorts import weekly_cohort_retention
    from ledgerlark.oracle.marts_sql import retention_sql

    for by, name in (("segment", "retention_by_segment"), ("signup_channel", "retention_by_channel")):
        register(name, retention_sql(by))(lambda wh, b=by: weekly_cohort_retention(wh.stg_users, wh.stg_conversations, (b,)))
    register("provider_anomalies", "SELECT * FROM m_provider_anomalies", True,
             reads=("mart_model_reliability_daily", "fct_daily_product_metrics"))(lambda wh: provider_anomalies(
        wh.mart_model_reliability_daily, wh.fct_daily_product_metrics, wh.config.anomaly))
    for unit in ("week", "month"):
        register(f"{unit}ly_kpis", rollup_sql(unit), staged_requests=True)(lambda wh, u=unit: rollup_kpis(
            wh.int_daily_product_metrics, wh.stg_conversations, wh.priced_requests, u))
    register("request_price_lookup", """
        SELECT r.request_id, r.request_date, r.model_name, p.input_price_per_1k_tokens, p.output_price_per_1k_tokens
        FROM s_llm_requests r
        LEFT JOIN s_daily_model_prices p ON r.model_name = p.model_name AND r.request_date = p.price_date""")(
        lambda wh: price_of_day(wh.stg_llm_requests, wh.stg_daily_model_prices).select(
            "request_id", "request_date", "model_name", "input_price_per_1k_tokens", "output_price_per_1k_tokens"))
    register("defect_manifest", DEFECT_MANIFEST_SQL)(lambda wh: injected(wh)[1])
    register("stg_llm_requests_incremental", "SELECT * FROM s_llm_requests")(incremental_requests)
    register("manifest_reconciliation", RECONCILIATION_SQL)(reconciliation)


_register_extensions()


_register_checks()


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(name, fn):
        if name in ON_WRITTEN_LAYERS:
            return lambda spark, sf_dir: publish(fn(materialized_warehouse(spark, sf_dir, reads=ON_WRITTEN_LAYERS[name])))
        if name in ON_STAGED_REQUESTS:
            return lambda spark, sf_dir: publish(fn(materialized_warehouse(spark, sf_dir, STAGED_REQUESTS)))
        if name in ON_TYPED_REQUESTS:
            return lambda spark, sf_dir: publish(fn(materialized_warehouse(spark, sf_dir, TYPED_REQUESTS)))
        return lambda spark, sf_dir: publish(fn(Warehouse.from_driver_tables(spark, sf_dir)))
    return {name: make(name, fn) for name, fn in SPARK.items()}


def oracle_queries() -> dict[str, str]:
    from ledgerlark.oracle.decimal_columns import DECIMAL_COLUMNS

    out = {}
    for name, final in ORACLE.items():
        dec = DECIMAL_COLUMNS.get(name, [])
        if dec:
            repl = ", ".join(f"cast({c} as double) AS {c}" for c in dec)
            final = f"SELECT * REPLACE ({repl}) FROM ({final}) q"
        out[name] = build(final, materialize=name == "check_suite").replace(
            "{incident}", WarehouseConfig().incident_date).replace(
            "{incident_start}", incident_window(WarehouseConfig())[0]).replace(
            "{incident_end}", incident_window(WarehouseConfig())[1])
    return out
