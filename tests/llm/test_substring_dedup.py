"""Repeated spans against a plain scan over all windows."""

import random

import numpy as np

from ledgerlark.llm import substring_dedup
from ledgerlark.llm.substring_dedup import POSITION_BITS, drop_repeated_spans, repeated_spans


def brute(rows, k):
    """Kept text by (doc_id, text); of one doc_id the texts are ordered as the operator orders them."""
    seen, out = set(), {}
    for i, t in rows:
        w = (t or "").encode().split()
        keep, mine = [True] * len(w), []
        for p in range(len(w) - k + 1):
            x = tuple(w[p : p + k])
            if x in seen:
                keep[p : p + k] = [False] * k
            seen.add(x)
        out[i] = b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode()
        seen.update(mine)
    return out


def test_equals_scan(make_docs, prose):
    rng, passages = random.Random(5), [prose(50 + i, n) for i, n in enumerate([60, 25, 20, 19, 140])]
    rows = []
    for i in range(60):
        words = prose(200 + i, rng.randrange(0, 80), 600)
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p))
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = p[a : a + rng.randrange(5, 90)]
        rows.append((i * 3 - 20, " ".join(words)))
    rows += [(500, "Of " * 300), (501, "Of " * 30), (502, rows[5][1]), (503, rows[5][1] + " more"), (504, "a b"), (505, None), (506, "")]
    out = drop_repeated_spans(make_docs(rows, clash=True)).collect()
    assert {r.doc_id: r.kept_text for r in out} == brute(rows, 20)
    n = {i: len((t or "").split()) for i, t in rows}
    assert all(r.n_words == n[r.doc_id] and r.n_removed == r.n_words - len(r.kept_text.split()) for r in out)


def test_odd_rows(make_docs, odd_rows):
    out = drop_repeated_spans(make_docs(odd_rows, clash=True)).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert len(out) == len(odd_rows)
    assert by[5][0].n_removed == 0 and [r.n_removed for r in by[6]] == [60, 60]
    assert {r.n_removed for r in by[None]} == {0} and by[7][0].n_words == 30_000
    assert drop_repeated_spans(make_docs([])).count() == 0


def test_several_texts_of_one_id(make_docs, prose):
    a, b = " ".join(prose(1, 50)), " ".join(prose(2, 30) + prose(1, 50))
    out = drop_repeated_spans(make_docs([(1, a), (1, b)])).collect()
    assert sorted(r.n_removed for r in out) in ([0, 50],)   # the later of the two in hash order gives way


def test_hash_collisions_are_caught(make_docs, prose, monkeypatch):
    """With window hashes of three bits nearly every edge is a clash; digests must sort them out."""
    real = substring_dedup.fold

    def weak(hashes, k):
        g = real(hashes, k)
        return g & np.uint64(7) if k == 20 else g

    p = prose(3, 45)
    rows = [(1, " ".join(prose(4, 30) + p)), (2, " ".join(p + prose(5, 30))), (3, " ".join(prose(6, 25) + p[:30])), (4, " ".join(prose(4, 28)))]
    import ledgerlark.llm.substring_dedup as module
    monkeypatch.setattr(module, "_edge_rows", weak_edges(module, weak))
    out = drop_repeated_spans(make_docs(rows)).collect()
    assert {r.doc_id: r.kept_text for r in out} == brute(rows, 20)


def weak_edges(module, weak):
    real = module._edge_rows

    def edge_rows(k, seed):
        run = real(k, seed)

        def again(batches):
            import pyarrow as pa
            import pyarrow.compute as pc

            for b in run(batches):
                yield pa.RecordBatch.from_arrays([pc.bit_wise_and(b.column(0), pa.scalar(7, pa.int64())), b.column(1)], names=["edge", "at"])

        return again

    return edge_rows


def test_paths_name_their_sources(make_docs, prose):
    """A passage of 45 words in three documents: two paths of 26 windows with the coordinates of the first."""
    p = prose(3, 45)
    rows = [(10, " ".join(prose(4, 7) + p)), (20, " ".join(p + prose(5, 9))), (30, " ".join(prose(6, 3) + p)), (40, rows_of := " ".join(prose(8, 60))), (50, rows_of)]
    paths, ranks, copies = repeated_spans(make_docs(rows))
    did = {r["rank"]: r.did for r in ranks.collect()}
    low = (1 << POSITION_BITS) - 1
    got = {(did[r.at >> POSITION_BITS], r.at & low, did[r.source >> POSITION_BITS], r.source & low, r.n) for r in paths.collect()}
    assert got == {(20, 0, 10, 7, 26), (30, 3, 10, 7, 26)}
    assert [(r.did) for r in copies.collect()] == [50]
