"""The fixture mapping reproduces the published feed statistics (FIXTURES.md)."""
from pyspark.sql import functions as F

from ledgerlark.sources.feeds import derive_feeds


def test_feed_counts_sf0001(spark):
    f = derive_feeds(spark, "/root/testdata/sf0.001")
    assert f["users"].count() == 150
    assert f["conversations"].count() == 1419
    assert f["escalations"].count() == 259
    assert f["daily_model_prices"].count() == 92 * 5
    r = f["llm_requests"].agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.countDistinct("request_id")).alias("replays"),
        F.count_if(F.col("conversation_id") == "").alias("orphans"),
        F.count_if(F.col("latency_ms").startswith("-")).alias("neg"),
        F.count_if(F.col("model_name").endswith("-preview")).alias("aliases"),
    ).first()
    assert (r.rows, r.replays, r.orphans, r.neg, r.aliases) == (5696, 8, 8, 1, 10)


def test_feeds_are_text(spark):
    for df in derive_feeds(spark, "/root/testdata/sf0.001").values():
        assert all(t == "string" for _, t in df.dtypes)


def test_clean_feeds_have_no_defects(spark):
    f = derive_feeds(spark, "/root/testdata/sf0.001", clean=True)
    r = f["llm_requests"]
    assert r.count() == r.select("request_id").distinct().count()
    assert r.where((F.col("conversation_id") == "") | F.col("latency_ms").startswith("-")).count() == 0
