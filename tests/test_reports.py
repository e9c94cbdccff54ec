"""Report filters and SQL views over a small warehouse."""
from pyspark.sql import functions as F

from ledgerlark.plans import reports as R


def test_report_filters(small_warehouse, spark):
    wh = small_warehouse
    f = R.ReportFilter("2024-02-01", "2024-02-29", ("gpt-4.1", "gemini-2.5-flash"))
    costs = R.daily_model_costs(wh.fct_daily_model_costs, f)
    bounds = costs.agg(F.min("request_date").alias("lo"), F.max("request_date").alias("hi")).first()
    assert str(bounds.lo) >= "2024-02-01" and str(bounds.hi) <= "2024-02-29"
    assert {r.model_name for r in costs.select("model_name").distinct().collect()} <= set(f.models)
    by_model = R.cost_by_model(wh.fct_daily_model_costs, f).collect()
    assert [r.model_name for r in sorted(by_model, key=lambda r: r.ord)] == list(f.models)
    tiles = R.headline_tiles(wh.fct_daily_product_metrics, f).first()
    assert 0 < tiles.error_rate < 1 and 1 <= tiles.avg_csat <= 5
    dist = R.confidence_distribution(wh.fct_conversations).collect()
    assert len(dist) == 5 and sum(r.n for r in dist) == wh.fct_conversations.count()


def test_sql_views(small_warehouse, spark):
    views = small_warehouse.register_views(["fct_daily_product_metrics"], prefix="t_")
    assert views == ["t_fct_daily_product_metrics"]
    n = spark.sql("SELECT count(*) AS n FROM t_fct_daily_product_metrics WHERE NOT is_partial_day").first().n
    assert n > 0
