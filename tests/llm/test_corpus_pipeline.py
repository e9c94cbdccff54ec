"""The corpus pipeline stage by stage, and the registered queries."""

import os
import random
import sys

import duckdb

import corpus_pipeline
from ledgerlark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, make_docs, prose, tmp_path):
    rng, rows, labels = random.Random(3), [], []
    item = " ".join(prose(77, 30))
    for i in range(120):
        words, good = prose(i, 80), 1
        if i % 10 == 3:
            words, good = ["JUNK!!", "###"] * 60, 0
        text = " ".join(words)
        if i % 10 == 5:
            text += " " + item
        if i % 10 == 7:
            text = rows[i - 7][1].replace(words[3], "x", 1) + " tail"
        rows.append((i, text, f"s{i % 3}"))
        labels.append((i, good, 0))
    lines = "\n".join(" ".join(prose(900 + j, 6)) for j in range(12))
    rows += [(200, lines), (201, " ".join(prose(990, 40)) + "\n" + lines + "\n" + " ".join(prose(991, 40))), (202, None), (None, "no id " + " ".join(prose(992, 20))), (203, "")]
    docs = make_docs(rows, clash=True)
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    ids = lambda df: {r.doc_id for r in df.collect()}
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.cut(stage(spark, at, d), name)
        assert at.columns == docs.columns
        seen[name] = ids(at)
    junk, leaks = set(range(3, 120, 10)), set(range(5, 120, 10))
    copies = {i for i in range(7, 120, 10)}
    assert not seen["quality"] & junk and seen["quality"] >= {i for i, *_ in rows if i is not None and i < 200} - junk
    assert seen["line_dedup"] == seen["quality"]
    kept = {r.doc_id: r.text for r in at.collect()}
    if 201 in kept:
        assert kept[201].count("\n") < 12
    assert seen["line_dedup"] - seen["near_dup"] == copies
    assert seen["near_dup"] - seen["decontaminate"] == leaks
    assert None in seen["decontaminate"]
    mixed = corpus_pipeline.run(spark, d)
    assert {r.doc_id for r in mixed.collect()} <= seen["decontaminate"] and mixed.count() > 50


def test_empty_tables(spark, make_docs, tmp_path):
    d = str(tmp_path)
    make_docs([]).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_oracles_agree(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    for name, sql in ORACLES.items():
        ours = QUERIES[name](spark, SMALL)
        theirs = con.execute(sql)
        cols = [c[0] for c in theirs.description]
        assert sorted(cols) == sorted(ours.columns), name
        assert sorted(map(repr, map(tuple, ours.select(*cols).collect()))) == sorted(map(repr, theirs.fetchall())), name


def test_entry_registers_one_query_per_operator():
    sys.path.insert(0, os.path.dirname(corpus_pipeline.__file__))
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
