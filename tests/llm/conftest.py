"""Small document tables with the awkward cases every operator must stand."""

import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source]) to a documents table; ``clash`` adds columns named like internal ones."""
    def make(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            for c in ("id", "did", "th", "node", "key", "row", "item", "score", "stats", "component", "hash", "sub", "rank", "label", "tokens", "rest", "gone"):
                df = df.withColumn(c, F.lit("x"))
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n invented words."""
    def words(seed, n, vocabulary=4000):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return words


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Null, empty, blank, short, very long and repeated rows, and a null id."""
    text = " ".join(prose(1, 60))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, text), (6, text), (6, text), (None, text), (None, None),
            (7, " ".join(prose(2, 30_000))), (8, "é ü " * 40)]
