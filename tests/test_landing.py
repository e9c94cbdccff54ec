"""Strict CSV landing, stored load times, freshness, manifest."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.invariants import source_freshness
from ledgerlark.sources.feeds import derive_feeds
from ledgerlark.sources.landing import (FEED_COLUMNS, land_feeds, landing_counts, read_feeds, read_landing, read_manifest, write_feeds,
                                        write_manifest)


def write(tmp_path, *lines):
    (tmp_path / "users").mkdir(exist_ok=True)
    (tmp_path / "users" / "a.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "users")


HEADER = ",".join(FEED_COLUMNS["users"])


def test_quotes_blanks_and_breaks_survive(spark, tmp_path):
    path = write(tmp_path, HEADER, 'u1,2024-01-01,"a ""q"", b", premium ,x', 'u2,2024-01-01,"two\nlines",,y')
    rows = read_landing(spark, path, "users", line_breaks=True).orderBy("user_id").collect()
    assert tuple(rows[0]) == ("u1", "2024-01-01", 'a "q", b', " premium ", "x")
    assert rows[1].country == "two\nlines" and rows[1].segment is None


@pytest.mark.parametrize("lines", [
    ["created_at,user_id,country,segment,signup_channel", "2024-01-01,u1,fr,x,y"],   # reordered header
    [HEADER, "u1,2024-01-01,fr"],                                                     # short row
    [HEADER, "u1,2024-01-01,fr,x,y,z"],                                               # long row
])
def test_malformed_files_stop_the_load(spark, tmp_path, lines):
    with pytest.raises(Exception):
        read_landing(spark, write(tmp_path, *lines), "users").select("user_id").distinct().collect()


@pytest.mark.parametrize("last", ['u2,2024-01-01,"two\nlines",,y', 'u2,2024-01-01,fr,x,"y', 'u2,2024-01-01,fr,x,y"'])
def test_unbalanced_quotes_stop_the_load_with_their_file(spark, tmp_path, last):
    path = write(tmp_path, HEADER, 'u1,2024-01-01,"a ""q"", b", premium ,x', last)
    rows = read_landing(spark, path, "users")
    for job in (rows.count, lambda: rows.select("user_id").distinct().collect(), lambda: rows.write.parquet(str(tmp_path / "out"))):
        with pytest.raises(Exception, match="unbalanced quote in .*a.csv|MALFORMED"):
            job()


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    path = write(tmp_path, HEADER, *[f'u{i},2024-01-01,"a ""q"", {i}", premium ,{"x" * 60}' for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = read_landing(spark, path, "users")
        used = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(used) >= 5 and sum(r.n for r in used) == 20_000
        assert rows.where("country <> concat('a \"q\", ', substr(user_id, 2))").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_declared_line_breaks_round_trip(spark, tmp_path):
    feeds = derive_feeds(spark, "/root/testdata/sf0.001")
    feeds["users"] = feeds["users"].withColumn("country", F.concat(F.lit("two\nlines, "), F.col("country")))
    write_feeds(feeds, str(tmp_path / "extracts"))
    with pytest.raises(Exception):
        land_feeds(spark, str(tmp_path / "extracts"), str(tmp_path / "no"))
    land_feeds(spark, str(tmp_path / "extracts"), str(tmp_path / "tables"), line_breaks=("users",))
    landed = read_feeds(spark, str(tmp_path / "tables"))["users"]
    assert landed.where("country not like 'two%' and country is not null").count() == 0 and landed.count() == 150


def test_landed_feeds_equal_their_source(spark, tmp_path):
    feeds = derive_feeds(spark, "/root/testdata/sf0.001")
    write_feeds(feeds, str(tmp_path / "extracts"))
    land_feeds(spark, str(tmp_path / "extracts"), str(tmp_path / "tables"), "2024-04-01 00:00:00")
    landed = read_feeds(spark, str(tmp_path / "tables"))
    for name, columns in FEED_COLUMNS.items():
        blank = lambda df: df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in columns])
        assert blank(landed[name]).exceptAll(blank(feeds[name])).count() == 0, name
        assert landed[name].count() == feeds[name].count()
        assert landed[name].select("_loaded_at").distinct().collect()[0][0] == dt.datetime(2024, 4, 1)
    assert {r.table_name: r.n_rows for r in landing_counts(landed).collect()}["raw_users"] == 150
    # the stamp is stored: reading again later does not make the tables younger
    again = source_freshness({f"raw_{n}": df for n, df in read_feeds(spark, str(tmp_path / "tables")).items()}, "2024-04-02 12:00:00")
    assert {(r.age_hours, r.status) for r in again.collect()} == {(36.0, "warn")} and again.count() == 6


def test_freshness_states(spark):
    def table(ts):
        return spark.createDataFrame([(ts,)] if ts else [], "x string").select(F.col("x").cast("timestamp").alias("_loaded_at"))

    tables = {"a": table("2024-04-01 00:00:00"), "b": table("2024-03-30 23:00:00"), "c": table("2024-03-20 00:00:00"), "d": table(None)}
    now = spark.sql("select timestamp'2024-04-01 06:00:00' as as_of")
    for as_of in (now, "2024-04-01 06:00:00"):
        assert {r.table_name: r.status for r in source_freshness(tables, as_of).collect()} == {"a": "pass", "b": "warn", "c": "error", "d": "error"}
    assert {r.status for r in source_freshness(tables, now, 10_000, 20_000).collect() if r.table_name != "d"} == {"pass"}


def test_manifest_round_trip(spark, tmp_path):
    m = spark.createDataFrame([("raw_llm_requests", "request_id", 'r "1", 2 ', "late")], "table_name string, key_column string, key_value string, issue string")
    write_manifest(m, str(tmp_path / "m"))
    assert read_manifest(spark, str(tmp_path / "m")).collect() == m.collect()


def test_shared_folder_is_required_off_local(monkeypatch):
    from types import SimpleNamespace

    from ledgerlark.session import checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))
