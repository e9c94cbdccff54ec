"""Repeated byte strings against a plain count of all windows."""

import random
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import suffix_dedup
from ledgerlark.llm.suffix_dedup import Hashes, covered, drop_repeated_bytes


def brute(texts, length):
    texts = [(i, (t or "").encode()) for i, t in texts]
    count = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), len(b) - len(kept), sum(gone[p] and not (p and gone[p - 1]) for p in range(len(b))), kept))
    return sorted(out, key=str)


def found(df, length):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in drop_repeated_bytes(df, length).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10 ** rng.randrange(1, 6))}" for _ in range(400)]

    def prose(least, most):
        return " ".join(rng.choice(words) for _ in range(rng.randrange(least, most)))

    passages, rows = [prose(20, 150) for _ in range(6)], []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.4:   # the middle of a passage, cut anywhere
                p = rng.choice(passages)
                a = rng.randrange(0, len(p) // 2)
                parts.append(p[a : rng.randrange(a, len(p))])
            elif kind < 0.5:
                parts.append(rng.choice(["a", "ab", "xyz "]) * rng.randrange(1, 900))
            elif kind < 0.55:
                parts.append("é漢字" * rng.randrange(1, 200))
            else:
                parts.append(prose(1, 200))
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed, length", [(0, 200), (1, 60)])
def test_equals_count_of_all_windows(make_docs, seed, length):
    rows = corpus(seed)
    rows += [rows[0], rows[0], rows[1], (None, rows[2][1]), (None, None), (None, "a" * 5000), (7, "another text of the same id"),
             (100, None), (101, ""), (102, "x" * (length - 1)), (103, "x" * length), (104, "y" * (length + 1))]
    assert found(make_docs(rows, clash=True), length) == brute(rows, length)


def test_texts_of_several_pieces(make_docs, prose, monkeypatch):
    """A long text is read in pieces; a repeat may lie across their edge."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 12)
    a, b = " ".join(prose(1, 4000)), " ".join(prose(2, 1500))
    rows = [(1, a), (2, b + a[3000:9000]), (3, "z" * 9000), (4, b)]
    run = suffix_dedup._entries(200)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for _, t in rows]), pa.array([1, 2, 3, 4]), pa.array([0, 0, 0, 0])], names=["text", "text_hash", "bits"])
    starts = Counter()
    for out in run([batch]):
        kind, key, at, first = (out.column(c).to_pylist() for c in ("kind", "text_hash", "at", "first"))
        for k, t, p, f in zip(kind, key, at, first, strict=True):
            if k < 2 and t != 3:   # the third text repeats itself: its runs are kind 2 and its entries come once
                for s in range((p >> 8) & 0xFFFFFFFF, ((p >> 8) & 0xFFFFFFFF) + (p & 255)):
                    starts[t, s] += 1
    for i, t in rows:
        if i != 3:
            assert [starts[i, s] for s in range(len(t) - 199)] == [1] * (len(t) - 199)   # every window start once
    monkeypatch.undo()
    assert found(make_docs(rows), 200) == brute(rows, 200)


def test_a_third_of_all_rows_is_one_text(make_docs, prose):
    same = " ".join(prose(9, 300))
    rows = [(i, " ".join(prose(i, 40)) + (same[100:700] if i % 7 == 0 else "")) for i in range(20, 80)] + [(5, same)] * 30
    assert found(make_docs(rows), 200) == brute(rows, 200)


def test_no_rows(make_docs):
    assert drop_repeated_bytes(make_docs([])).collect() == []


def test_hashes_of_spans():
    buf = np.frombuffer(b"abcabcabdabc", np.uint8)
    h = Hashes(buf)
    start, end = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 12])
    for one in (h.of(start, end), h.second(start, end)):
        assert one[0] == one[1] == one[3] != one[2]


def test_spans_merge_where_they_touch():
    assert covered(np.array([[10, 3], [0, 1], [40, 1]]), 10, 45) == [(0, 22), (40, 45)]
