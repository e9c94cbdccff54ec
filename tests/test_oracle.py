"""Spark queries agree with their independent DuckDB formulation (subset, smallest fixture)."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from compare_oracle import close, rows  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["stg_llm_requests", "int_conversation_request_rollup", "fct_daily_product_metrics",
         "mart_daily_anomalies", "fct_weekly_cohort_retention", "mart_intent_quality", "weekly_kpis",
         "landing_counts", "defect_manifest"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "customer", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    rs, rd = rows(s), rows(d)
    assert len(rs) == len(rd)
    assert all(close(x, y) for a, b in zip(rs, rd) for x, y in zip(a, b))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "metric_date" in df.columns
