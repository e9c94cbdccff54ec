"""Quality rules and toxicity: held-out accuracy, rules as columns, awkward rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm.quality_rules import STATISTICS, RuleModel, fit_rules, keep_quality, lasso_logistic, quality_scores, rule_matrix, statistics
from ledgerlark.llm.toxicity import label_model, logistic, toxicity_scores

LABELS = "doc_id long, quality int, toxic int, label int, text string"


def labels_frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], LABELS)


@pytest.fixture(scope="module")
def corpus(spark, make_docs, prose):
    """Prose, junk of four kinds, and texts with invented insults (a root with changing endings)."""
    rng, docs, labels = random.Random(9), [], []
    for i in range(700):
        words, good, toxic = prose(i, rng.randrange(5, 200)), 1, 0
        kind = rng.random()
        if kind < 0.06:
            words, good = [rng.choice(words)] * len(words) * 2, 0
        elif kind < 0.12:
            words, good = [w.upper() + "!!" for w in words], 0
        elif kind < 0.18:
            words, good = [w + rng.choice(["###", "$$$", "&&&"]) for w in words], 0
        elif kind < 0.4:
            toxic = 1
            for _ in range(rng.randrange(2, 5)):
                words[rng.randrange(len(words))] = rng.choice(["grolm", "vexil"]) + rng.choice("abcdefgh")
        docs.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, good, toxic))
    labels += [(None, 1, 1), (10_000, None, None), labels[0], (labels[1][0], None, 1)]
    return make_docs(docs, clash=True), labels_frame(spark, labels), {i: (g, t) for i, g, t in labels if g is not None and i is not None}


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_held_out(spark, corpus):
    docs, labels, truth = corpus
    out = quality_scores(docs, labels).collect()
    assert len(out) == 700 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == fold(r.doc_id) for r in out)
    test = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(test) > 60 and np.mean([r.predicted == truth[r.doc_id][0] for r in test]) > 0.95
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.predicted}


def test_toxicity_held_out(spark, corpus):
    docs, labels, truth = corpus
    out = toxicity_scores(docs, labels).collect()
    assert len(out) == 700 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == fold(r.doc_id) for r in out)
    test = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id][1] for r in test]) > 0.95


def test_labels_of_the_fold_do_not_matter(spark, corpus):
    docs, labels, _ = corpus
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_odd_rows_and_no_labels(spark, make_docs, odd_rows, corpus):
    docs, none = make_docs(odd_rows, clash=True), labels_frame(spark, [])
    for scores in (quality_scores, toxicity_scores):
        for labels in (none, corpus[1]):
            out = scores(docs, labels).collect()
            assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
            assert {r.held_out for r in out if r.doc_id is None} == {False}
        assert scores(make_docs([]), none).count() == 0
    assert keep_quality(docs, none).count() == len(odd_rows)


def test_statistics_of_known_texts():
    s = statistics(pa.array([None, "", "Ab cd!! ab\n\nab | é1", " ".join(["a"] * 300)]))
    assert all(s[n][0] == 0 and s[n][1] == 0 for n in STATISTICS)
    assert s["n_words"].tolist()[2:] == [6, 300] and s["n_lines"].tolist()[2:] == [2, 1]
    assert s["distinct_share"][2] == 5 / 6 and s["top_share"][3] == 1 and s["local_distinct"][3] == 3 / 300
    size = len("Ab cd!! ab\n\nab | é1".encode())
    assert s["bang_share"][2] == 2 / size and s["bar_share"][2] == 1 / size and s["wide_share"][2] == 2 / size


def test_rules_as_columns_equal_matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(STATISTICS)))
    y = ((x[:, 1] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    m = fit_rules(x, y)
    assert 0 < len(m.rules) < 80
    z = 1 / (1 + np.exp(-(rule_matrix(list(m.rules), x) @ np.array(m.weights) + m.bias)))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in STATISTICS))
    got = [r[0] for r in df.select(m.column(F.struct(*STATISTICS))).collect()]
    assert np.allclose(got, z, atol=1e-5) and ((z > 0.5) == (y > 0.5)).mean() > 0.98
    assert RuleModel((), (), 0.0).describe() == []


def test_lasso_finds_the_sparse_truth():
    rng = np.random.default_rng(2)
    a = (rng.random((2000, 60)) < 0.3).astype(np.float32)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * a[:, 4] - 3 * a[:, 9])))).astype(float)
    w, _ = lasso_logistic(a, y, 0.01)
    assert set(np.argsort(-np.abs(w))[:2]) == {4, 9} and (np.abs(w) > 1e-3).sum() < 12


def test_label_model_discounts_copies():
    """Ten copies of one poor voter count as about one; three good ones decide."""
    rng = np.random.default_rng(3)
    y = rng.random(3000) < 0.3

    def voter(acc):
        return np.where(rng.random(3000) < acc, np.where(y, 1, -1), np.where(y, -1, 1))

    poor = voter(0.6)
    v = np.stack([*[poor] * 10, voter(0.85), voter(0.85), voter(0.85)], axis=1)
    post, table, weight = label_model(v, 0.3)
    assert weight[:10].max() < 0.2 and weight[10:].min() > 0.6
    assert ((post > 0.5) == y).mean() > 0.9
    assert table[1][2][-1] > 0.7 and table[0][0][-1] > 0.7


def test_logistic_fits_soft_labels():
    x = np.array([[1.0], [0.0]] * 50)
    w, b = logistic(x, np.array([0.9, 0.2] * 50), ridge=0)
    p = 1 / (1 + np.exp(-(x[:2, 0] * w[0] + b)))
    assert abs(p[0] - 0.9) < 0.02 and abs(p[1] - 0.2) < 0.02
