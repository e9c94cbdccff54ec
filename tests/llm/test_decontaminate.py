"""Containment search against counting all shingles."""

import random

import ledgerlark.llm.decontaminate as module
from ledgerlark.llm.decontaminate import contaminated, drop_contaminated
from ledgerlark.llm.textnum import word_list


def grams(t):
    w = word_list(t, lower=True)
    return set(zip(*(w[i:] for i in range(5)), strict=False))


def brute(docs, items):
    out = {}
    for d, t in docs:
        have = grams(t)
        for i, u in items:
            want = grams(u)
            both = len(want & have)
            if i is not None and want and 100 * both >= 80 * len(want):
                out[(d, i)] = max(out.get((d, i), (0, 0)), (both, len(want)), key=lambda x: (x[0] / max(x[1], 1), x[0]))
    return out


def world(spark, make_docs, prose, odd_rows):
    rng = random.Random(2)
    items = [(i, " ".join(prose(300 + i, rng.randrange(5, 60)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "too few words"), (None, " ".join(prose(300, 20))), (3, items[4][1]), (33, items[5][1].upper())]
    docs = [r[:2] for r in odd_rows]
    for n in range(120):
        words = prose(600 + n, rng.randrange(0, 900))
        for _ in range(rng.randrange(0, 3)):
            x = (rng.choice(items[:25])[1]).split()
            for _ in range(rng.randrange(0, 3)):
                x[rng.randrange(len(x))] = "changed"
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = [w.upper() if n % 2 else w for w in x]
        docs.append((1000 + n, " ".join(words)))
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, item string, hash int")
    return docs, items, make_docs(docs, clash=True), bench


def test_pairs_equal_counting(spark, make_docs, prose, odd_rows, monkeypatch):
    docs, items, frame, bench = world(spark, make_docs, prose, odd_rows)
    expected = brute(docs, items)
    assert len(expected) > 40
    got = {(r.doc_id, r.item_id): (r.n_common, r.n_item) for r in contaminated(frame, bench).collect()}
    assert got == expected
    monkeypatch.setattr(module, "BLOCK_HASHES", 40)   # the same in several blocks of the benchmark
    assert {(r.doc_id, r.item_id): (r.n_common, r.n_item) for r in contaminated(frame, bench).collect()} == expected
    left = drop_contaminated(frame, bench)
    assert left.columns == frame.columns
    bad = {d for d, _ in expected}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((d for d, _ in docs if d is None or d not in bad), key=str)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([(1, "a b c d e f")])
    assert contaminated(docs, none).count() == 0 and drop_contaminated(docs, none).count() == 1
    assert contaminated(make_docs([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
