"""Vectorised words and shingles against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm.common import text_slices
from ledgerlark.llm.textnum import fold, hash_spans, shingle_sets, word_list, words_of

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té\x0b\x1cü. ", max_size=40)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 30))
def test_words_match(rows, most):
    seen, table = 0, {}
    for lo, buf, offs in text_slices(pa.array(rows, pa.string()), most):
        w = words_of(buf, offs, lower=True)
        for r in range(len(offs) - 1):
            expected = word_list(rows[lo + r], lower=True)
            a, b = w.first[r], w.first[r + 1]
            assert [bytes(buf[s:e]).lower() for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] == expected
            for word, h in zip(expected, w.hashes[a:b].tolist(), strict=True):
                assert table.setdefault(word, h) == h
            seen += 1
        sets = shingle_sets(w, 2)
        for r, s in enumerate(sets):
            x = word_list(rows[lo + r], lower=True)
            assert len(s) == len(set(zip(x, x[1:], strict=False)) if len(x) > 1 else set(x))
    assert seen == len(rows) and len(set(table.values())) == len(table)


def test_sliced_arrow_arrays():
    arr = pa.array(["zero", "one two", None, "three"]).slice(1)
    got = [(lo, bytes(buf), offs.tolist()) for lo, buf, offs in text_slices(arr)]
    assert got == [(0, b"one twothree", [0, 7, 7, 12])]


def test_long_words_and_fold():
    buf = np.frombuffer(b"x" * 3_000_000 + b" y", np.uint8)
    w = words_of(buf, np.array([0, len(buf)]))
    assert len(w.starts) == 2 and len(fold(w.hashes, 3)) == 0 and len(fold(w.hashes, 2)) == 1
    assert hash_spans(buf, np.array([0, 5]), np.array([0, 5]))[0] == hash_spans(buf, np.array([7]), np.array([7]))[0]
