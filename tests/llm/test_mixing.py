"""Mixing against a plain version, and its oracle."""

import hashlib
import math

import duckdb
import pytest

from ledgerlark.llm.mixing import mix_sources, mixing_weights, oracle, source_tokens


def brute(rows, entropy_share, most_epochs, budget=None, seed=1):
    tokens, docs = {}, {}
    for i, t, s in rows:
        n = len((t or "").encode().split())
        tokens[s] = tokens.get(s, 0) + n
        name = str(i) if i is not None else hashlib.md5(t.encode()).hexdigest() if t is not None else "null"
        docs.setdefault(s, []).append((i, n, name))
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    budget = total if budget is None else budget

    def at(a):
        p = {s: (n / total) ** a for s, n in tokens.items()}
        z = sum(p.values())
        return {s: x / z for s, x in p.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in at(a).values())

    def repetition(a):
        return max(budget * w / tokens[s] for s, w in at(a).items())

    def bisect(ok, lo, hi):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if ok(mid) else (lo, mid)
        return lo

    a = 1.0
    if len(tokens) > 1:
        goal = entropy_share * math.log(len(tokens))
        level = 1.0 if entropy(1) >= goal else 0.0 if entropy(0) < goal else bisect(lambda x: entropy(x) >= goal, 0, 1)
        bound = 0.0 if repetition(0) <= most_epochs else 1.0 if repetition(1) > most_epochs else bisect(lambda x: repetition(x) > most_epochs, 0, 1)
        a = max(level, bound)
    out = []
    for s, w in at(a).items() if tokens else ():
        target = math.floor(w * budget + 0.5)
        for epoch in range(target // tokens[s] + 1):
            start = 0
            for key, n, i in sorted((hashlib.md5(f"{seed}:{epoch}:{name}".encode()).hexdigest(), n, i) for i, n, name in docs[s]):
                if epoch < target // tokens[s] or start < target - epoch * tokens[s]:
                    out.append((i, s, epoch, n, round(w, 6)))
                start += n
    return sorted(out, key=str)


@pytest.mark.parametrize(("entropy_share", "most_epochs", "budget"), [(0.999, 4.0, None), (0.9, 1.7, None), (1.0, 50.0, 9000), (0.99, 4.0, 300), (0.5, 0.5, None)])
def test_equals_plain_version(make_docs, prose, entropy_share, most_epochs, budget):
    rows = [(i, " ".join(prose(i, 1 + i % 37)), f"s{int((i % 64) ** 0.5)}") for i in range(300)]
    rows += [(None, "a b c", "s1"), (None, "a b c", "s1"), (400, "x y", None), (401, None, "silent"), (402, "", "s2"), (7, rows[7][1], rows[7][2])]
    out = mix_sources(make_docs(rows, clash=True), budget, entropy_share, most_epochs).collect()
    expected = brute(rows, entropy_share, most_epochs, budget)
    assert sorted(((r.doc_id, r.source, r.epoch, r.n_tokens, r.weight) for r in out), key=str) == expected
    assert all(0 <= r.position < 1 for r in out)
    if entropy_share < 1:
        weights = mixing_weights(source_tokens(make_docs(rows)), budget, entropy_share, most_epochs).collect()
        assert abs(sum(r.weight for r in weights) - 1) < 1e-9


def test_oracle_and_empty(make_docs, prose, spark):
    docs = make_docs([(i, " ".join(prose(i, 3 + i % 50)), f"s{i % 7 * (i % 3)}") for i in range(200)])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    theirs = con.execute(oracle()).fetchall()
    ours = mix_sources(docs).select("doc_id", "source", "epoch", "n_tokens", "weight", "position").collect()
    assert sorted(map(tuple, ours)) == sorted(theirs)
    assert mix_sources(make_docs([])).count() == 0
    assert mix_sources(make_docs([(1, None), (2, "")])).count() == 0
    plan = mix_sources(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
