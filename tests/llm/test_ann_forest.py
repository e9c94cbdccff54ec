"""Forest search against brute force: recall, exact scores, ties, copies, awkward vectors."""

import numpy as np
import pytest

import ledgerlark.llm.ann_forest as module
from ledgerlark.llm.ann_forest import common_prefix, forest_search, usable


def frame(spark, rows):
    real = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(*r, "x", 1) for r in real], "vec_id long, embedding array<float>, rep string, id int")


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            ok[i] = min(ok.get(i, a), a, key=tuple)
    dims = [len(v) for v in ok.values()]
    dim = max(set(dims), key=lambda d: (dims.count(d), d)) if dims else 0
    ok = {i: v for i, v in ok.items() if len(v) == dim}
    return {q: sorted(((-float(v @ ok[q]), i) for i, v in ok.items() if i != q))[:k] for q in ok if q % 20 == 0}


def search(spark, rows, k=20):
    u = usable(frame(spark, rows), "vec_id", "embedding")
    got = {}
    for r in forest_search(u, u.where("id % 20 = 0"), k=k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def test_exact_on_small_tables_with_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(-40, 200)]   # many ties and equal vectors
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None, 1, 1, 1, 1]), (380, [float("nan")] * 6), (400, [float("inf")] + [1.0] * 5),
             (420, [1.0] * 5), (None, [1.0] * 6), (20, [9.0] * 6), (441, [-0.0, 1.0, 0, 0, 0, 0]), (460, [0.0, 1.0, 0, 0, 0, 0])]
    expected, got = brute(rows, 20), search(spark, rows)
    assert set(got) == set(expected)
    for q, want in expected.items():
        assert [(n, i) for n, i, _ in got[q]] == [(n + 1, i) for n, (_, i) in enumerate(want)]
        assert np.allclose([s for _, _, s in got[q]], [-s for s, _ in want], rtol=0, atol=1e-12)


def test_few_rows(spark):
    assert search(spark, []) == {}
    assert search(spark, [(20, [1.0, 2.0])]) == {}
    assert search(spark, [(20, [1.0, 2.0]), (21, [1.0, 2.0]), (40, [2.0, 1.0])]) == {20: [(1, 21, 5.0), (2, 40, 4.0)], 40: [(1, 20, 4.0), (2, 21, 4.0)]}


def test_a_vector_that_many_rows_share(spark):
    rows = [(i, [0.5, 0.5, 0.1]) for i in range(1, 900)] + [(1000 + i, [float(i), 1.0, 0.3]) for i in range(50)]
    got = search(spark, rows)
    assert [(n, i) for n, i, _ in got[40]][:2] == [(1, 1049), (2, 1048)]
    assert got == {q: [(n + 1, i, pytest.approx(-s)) for n, (s, i) in enumerate(w)] for q, w in brute(rows, 20).items()}


def test_recall_with_many_blocks(spark, monkeypatch):
    """Clustered vectors of different lengths, blocks far smaller than the table."""
    monkeypatch.setattr(module, "BLOCK", 128)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 24)) * 2
    x = (centres[rng.integers(0, 60, 3000)] + 0.3 * rng.standard_normal((3000, 24))) * rng.uniform(0.9, 1.1, (3000, 1))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    expected, got = brute(rows, 20), search(spark, rows)
    recall = np.mean([len({i for _, i, _ in got[q]} & {i for _, i in w}) / 20 for q, w in expected.items()])
    assert recall >= 0.9


def recall_of(spark, x):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    expected, got = brute(rows, 20), search(spark, rows)
    return np.mean([len({i for _, i, _ in got[q]} & {i for _, i in w}) / 20 for q, w in expected.items()])


def test_recall_when_three_blocks_are_a_small_share(spark, monkeypatch):
    """Nearly isotropic vectors: no prefix run that three blocks hold has all neighbours."""
    monkeypatch.setattr(module, "BLOCK", 16)
    assert recall_of(spark, np.random.default_rng(4).standard_normal((4000, 32))) >= 0.98


@pytest.mark.parametrize("jitter", [1e-4, 1e-3])
def test_recall_in_a_cluster_of_nearly_equal_vectors(spark, monkeypatch, jitter):
    """A third of the rows differ slightly, in runs of like strings longer than three blocks."""
    monkeypatch.setattr(module, "BLOCK", 32)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 16))
    x[:1000] = 2 * x[0] + jitter * rng.standard_normal((1000, 16))
    assert recall_of(spark, rng.permutation(x)) >= 0.98


def test_equal_strings_stand_in_another_order_in_each_tree(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 50)
    rows = [(tree, 7, rep, False) for tree in (0, 1) for rep in range(200)]
    placed = module._numbered(spark.createDataFrame(rows, "tree int, string long, rep long, is_query boolean")).collect()
    first = [{r.rep for r in placed if r.tree == tree and r.block == 4 * tree} for tree in (0, 1)]
    assert len(first[0]) == len(first[1]) == 50 and len(first[0] & first[1]) < 30


def test_common_prefix():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, (2, 40), dtype=np.uint64)
    b[:20] = a[:20] ^ (np.uint64(1) << np.arange(0, 60, 3, dtype=np.uint64))
    b[20] = a[20]
    bits = lambda x: format(int(x), "064b")
    got = common_prefix(a, b)
    for i in range(40):
        for j in range(40):
            p, q = bits(a[i]), bits(b[j])
            assert got[i, j] == next((n for n in range(64) if p[n] != q[n]), 64)
