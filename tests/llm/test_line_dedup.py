"""Line chunks against a scan of documents in order."""

import random

import numpy as np

from ledgerlark.llm.line_dedup import chunk_bounds, dedup_lines, drop_repeated_lines
from ledgerlark.llm.textnum import hash_spans


def line_hashes(lines):
    raw = [x.encode() for x in lines]
    ends = np.cumsum([len(x) for x in raw])
    return hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw], ends)


def brute(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        bounds, keep, mine = chunk_bounds(line_hashes(lines)), [], set()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            c = tuple(lines[a:b])
            if len(c) > 1 and (c in seen or c in mine):
                continue
            mine.add(c)
            keep += c
        seen |= {c for c in mine if len(c) > 1}
        out[i] = "\n".join(keep)
    return out


def world(prose):
    rng = random.Random(6)
    shared = [[" ".join(prose(40 * s + j, 8)) for j in range(rng.randrange(2, 14))] for s in range(6)]
    rows = []
    for i in range(80):
        lines = [" ".join(prose(5000 + 20 * i + j, 6)) for j in range(rng.randrange(0, 12))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(0, len(lines) + 1)
            lines[at:at] = rng.choice(shared)
        rows.append((i, "\n".join(lines)))
    return [*rows, (200, "a\n" * 30), (201, "\n\n\n"), (202, rows[7][1]), (203, rows[7][1])]


def test_equals_scan(make_docs, prose):
    rows = world(prose)
    docs, expected = make_docs(rows, clash=True), brute(world(prose))
    out = dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in out} == expected and sum(r.n_removed for r in out) > 50
    assert all(r.n_lines == rows_text.count("\n") + 1 for r in out for i, rows_text in rows if i == r.doc_id)
    left = drop_repeated_lines(docs)
    assert left.columns == docs.columns
    gone = {r.doc_id for r in out if r.n_removed == r.n_lines}
    assert gone and {r.doc_id: (r.text, r.n_chars, r.node) for r in left.collect()} == {
        i: (t, len(t), "x") for i, t in expected.items() if i not in gone}


def test_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (60, "p q\nr s\nt u"), (60, "p q\nr s\nt u"), (None, "p q\nr s\nt u"), (61, "same\nsame\nsame\nsame")]
    out = dedup_lines(make_docs(rows, clash=True)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[1][0].n_lines == 0 and by[2][0].text == ""
    assert [r.n_removed for r in by[60]] == [0, 0] and {r.n_removed for r in by[None]} == {0, 3}
    left = drop_repeated_lines(make_docs(rows))
    assert left.count() == len(rows) - 1
    assert dedup_lines(make_docs([])).count() == 0 and drop_repeated_lines(make_docs([])).count() == 0


def test_boundaries_follow_content(prose):
    lines = [" ".join(prose(i, 5)) for i in range(60)]
    a, b = (set((chunk_bounds(line_hashes(x)) - shift)[2:-2].tolist()) for x, shift in ((lines, 0), (lines[:3] + ["new"] + lines[3:], 1)))
    assert {x for x in a if x > 6} == {x for x in b if x > 6}
    assert (np.diff(chunk_bounds(line_hashes(lines)))[1:-1] >= 2).all()


def left_by_scan(rows):
    """Lines outside runs of two or more that earlier documents hold; the rows have no repeats inside a document."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        pairs = list(zip(lines[:-1], lines[1:], strict=True))
        bad = {j + d for j, p in enumerate(pairs) if p in seen for d in (0, 1)}
        seen |= set(pairs)
        out[i] = "\n".join(x for j, x in enumerate(lines) if j not in bad)
    return out


def test_whole_runs_equal_a_plain_scan(make_docs, prose):
    shared = [[" ".join(prose(40 * s + j, 8)) for j in range(2 + s)] for s in range(6)]
    rows = []
    for i in range(60):
        lines = [" ".join(prose(9000 + 20 * i + j, 6)) for j in range(i % 7)]
        at = i * 5 % (len(lines) + 1)
        rows.append((i, "\n".join(lines[:at] + shared[i % 6] + lines[at:])))
    rows += [(100, rows[3][1]), (101, "one\ntwo"), (102, "two\none"), (103, "zero\none\ntwo\nthree")]
    expected = left_by_scan(rows)
    assert expected[103] == "zero\nthree" and expected[102] == "two\none"
    got = dedup_lines(make_docs(rows, clash=True), runs=True).collect()
    assert {r.doc_id: r.text for r in got} == expected
    assert all(r.n_removed == dict(rows)[r.doc_id].count("\n") + 1 - (0 if r.n_removed == r.n_lines else r.text.count("\n") + 1) for r in got)
    left = drop_repeated_lines(make_docs(rows, clash=True), runs=True).collect()
    whole = {r.doc_id for r in got if r.n_removed == r.n_lines}
    assert 100 in whole and {r.doc_id: (r.text, r.n_chars) for r in left} == {i: (t, len(t)) for i, t in expected.items() if i not in whole}
