"""Near-duplicates against all pairs, and the awkward rows."""

import itertools
import random

from ledgerlark.llm.near_dup import (BLOCK, _shingles, connected_components, drop_near_duplicates, least_difference, most_difference,
                                     near_duplicates, parity_sketch)


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(_shingles(t, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        for s, t in itertools.product(sets[a], sets[b]):
            both = len(s & t)
            if both and 100 * both >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_components_equal_all_pairs(spark, make_docs, prose, odd_rows):
    rng, rows = random.Random(4), [r[:2] for r in odd_rows]
    for g in range(12):   # groups whose members differ by more or less than the threshold
        base = prose(100 + g, rng.randrange(20, 200))
        rows += [(100 * (g + 1) + j, edited(base, rng, rng.randrange(0, max(2, len(base) // 8)))) for j in range(rng.randrange(2, 12))]
    rows += [(5000 + j, " ".join(prose(900 + j, 50))) for j in range(40)]
    rows += [(6000, "A b C d"), (6001, "a B c D"), (6002, "x"), (6003, "X")]
    out = near_duplicates(make_docs(rows, clash=True), k=2, percent=80).collect()
    expected = brute(rows, 2, 80)
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)
    sizes = {r.doc_id: r.n_shingles for r in out if r.doc_id is not None}
    assert all(sizes[i] == len(_shingles(t, 2)) for i, t in rows if i is not None)


def test_one_row_of_each_group_stays(spark, make_docs, odd_rows, prose):
    text = " ".join(prose(1, 60))
    docs = make_docs([*odd_rows, (50, text + " tail")], clash=True)
    left = drop_near_duplicates(docs, k=5, percent=80)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 3, 4, 5, None, None, 7, 8], key=str)


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0
    assert drop_near_duplicates(make_docs([])).count() == 0


def test_links_that_no_pivot_sees(spark, make_docs, prose):
    """A large group around a base: members far from the pivot are still joined to each other, across blocks."""
    rng, base = random.Random(8), prose(7, 120)
    rows = [(i, edited(base, rng, rng.randrange(8, 22))) for i in range(1, BLOCK + 60)]
    out = near_duplicates(make_docs(rows), k=2, percent=80).collect()
    expected = brute(rows, 2, 80)
    assert {r.doc_id: r.component_id for r in out} == expected


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 999), (999, 998), (2000, 2000 + 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 201)) and got[1000] == 998 and got[2007] == 2000


def test_sketch_never_overstates(prose):
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        n, m, both = rng.integers(1, 900, 3)
        both = min(both, n, m)
        x = np.unique(rng.integers(0, 2**63, n + m, dtype=np.uint64))
        a, b = x[:n], np.concatenate([x[:both], x[n : n + m - both]])
        d = least_difference(*(np.frombuffer(parity_sketch(s), np.uint8) for s in (a, b)))
        assert d <= len(a) + len(b) - 2 * both
    assert most_difference(np.int64(10), np.int64(8), 80) == 2
