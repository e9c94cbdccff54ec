"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of each whole text (an Arrow function; one row in, one struct out).
2. Boosted shallow trees on a bounded labelled sample; the path to every node is a
   conjunctive rule such as ``symbol_share > 0.08 and distinct_share <= 0.4``.
3. Logistic regression with an L1 penalty over the rules; most weights become zero.
4. The rules that remain compile into one Spark column expression, so scoring all
   documents is a projection without shuffle.

Only the statistics of the sample (``SAMPLE`` rows of a few numbers) reach the
driver.  Defined results: null and empty texts have all statistics zero and are
scored like any other.  Without usable labels, or with labels of one kind, the
score is the share of label 1 (1 when there are none).  Rows that repeat are each
scored; extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import held_out, ship_package, text_slices
from ledgerlark.llm.labelled import training_rows
from ledgerlark.llm.textnum import hash_spans, spans, words_of

#: Labelled documents that the rules are fitted on, at most.
SAMPLE = 10_000
#: A document is rejected below this score.
REJECT_BELOW = 0.3

STATISTICS = ("n_words", "word_length", "distinct_share", "local_distinct", "top_share", "upper_share", "symbol_share", "digit_share",
              "stop_share", "bang_share", "bar_share", "wide_share", "n_lines", "distinct_lines", "line_words")

_CLASSES = {   # byte classes counted per text
    "upper_share": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "symbol_share": b"#$%&*+<=>@\\^_`{}~", "digit_share": b"0123456789",
    "stop_share": b".,;:?", "bang_share": b"!", "bar_share": b"|",
}
_STRETCH = np.uint64(0x9E3779B97F4A7C15)
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _membership(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Every statistic of every text as one float array each."""
    out = {s: np.zeros(len(texts)) for s in STATISTICS}
    masks = {s: _membership(c) for s, c in _CLASSES.items()}
    for lo, buf, offs in text_slices(texts):
        rows = slice(lo, lo + len(offs) - 1)
        size = np.maximum(np.diff(offs), 1)
        wide = np.concatenate([[0], np.cumsum(buf >= 128)])
        out["wide_share"][rows] = np.diff(wide[offs]) / size
        for s, m in masks.items():
            out[s][rows] = np.diff(np.concatenate([[0], np.cumsum(m[buf])])[offs]) / size
        w = words_of(buf, offs)
        n = np.diff(w.first)
        out["n_words"][rows] = n
        out["word_length"][rows] = np.diff(np.concatenate([[0], np.cumsum(w.ends - w.starts)])[w.first]) / np.maximum(n, 1)
        ls, le = spans(buf, offs, _NEWLINE)   # lines that are not empty
        lh, lf = hash_spans(buf, ls, le), np.searchsorted(ls, offs)
        out["n_lines"][rows] = np.diff(lf)
        out["line_words"][rows] = n / np.maximum(np.diff(lf), 1)
        for r in range(len(n)):
            if n[r]:
                h = w.hashes[w.first[r] : w.first[r + 1]]
                _, c = np.unique(h, return_counts=True)
                out["distinct_share"][lo + r] = len(c) / n[r]
                # The same within stretches of 100 words: does not sink with the length.
                stretch = np.arange(n[r], dtype=np.uint64) // np.uint64(100)
                out["local_distinct"][lo + r] = len(np.unique(h + stretch * _STRETCH)) / n[r] if n[r] > 100 else len(c) / n[r]
                out["top_share"][lo + r] = c.max() / n[r]
            lines = lh[lf[r] : lf[r + 1]]
            out["distinct_lines"][lo + r] = len(np.unique(lines)) / max(len(lines), 1)
    return out


def statistics_column(docs: DataFrame, text: Column) -> Column:
    """A struct column with the statistics of ``text``."""
    ship_package(docs.sparkSession)

    @F.arrow_udf(", ".join(f"{s}: double" for s in STATISTICS))
    def measure(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        s = statistics(texts)
        return pa.StructArray.from_arrays([pa.array(s[n]) for n in STATISTICS], names=list(STATISTICS))

    return measure(text)


Rule = tuple[tuple[int, bool, float], ...]   # (statistic, is above, threshold), all of which hold


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self, stats: Column) -> Column:
        """The score as a Spark expression over a statistics struct."""
        z = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            held = F.lit(True)
            for f, above, t in rule:
                c = stats.getField(STATISTICS[f])
                held = held & ((c > t) if above else (c <= t))
            z = z + F.when(held, F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{STATISTICS[f]} {'>' if a else '<='} {t:.4g}" for f, a, t in r)
                for r, w in sorted(zip(self.rules, self.weights, strict=True), key=lambda x: -abs(x[1]))]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int = 5) -> list[Rule]:
    """Paths to all nodes of boosted regression trees on the logistic residual."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, 49))) for c in x.T]
    bins = np.stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T, strict=True)], axis=1)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    z, found = np.full(len(y), np.log(rate / (1 - rate))), {}
    for _ in range(trees):
        res, use = y - _sigmoid(z), rng.random(len(y)) < 0.6
        cols = rng.permutation(x.shape[1])[: max(4, x.shape[1] * 2 // 3)]
        stack: list[tuple[np.ndarray, Rule]] = [(np.arange(len(y)), ())]
        while stack:
            rows, rule = stack.pop()
            fit = rows[use[rows]]
            if rule:
                found.setdefault(tuple(sorted(set(rule))))
            best = (1e-6, 0, 0)
            if len(rule) < depth and len(fit) >= 10:
                total, n = res[fit].sum(), len(fit)
                for f in cols:
                    k = len(cuts[f]) + 1
                    s = np.cumsum(np.bincount(bins[fit, f], res[fit], k))[:-1]
                    m = np.cumsum(np.bincount(bins[fit, f], minlength=k))[:-1]
                    ok = (m >= 3) & (n - m >= 3)
                    if ok.any():
                        gain = np.where(ok, s**2 / np.maximum(m, 1) + (total - s) ** 2 / np.maximum(n - m, 1) - total**2 / n, 0)
                        c = int(gain.argmax())
                        best = max(best, (float(gain[c]), int(f), c))
            if best[0] > 1e-6:
                _, f, c = best
                left, t = bins[rows, f] <= c, float(cuts[f][c])
                stack += [(rows[left], (*rule, (f, False, t))), (rows[~left], (*rule, (f, True, t)))]
            elif rule and len(fit):
                p = _sigmoid(z[fit])
                z[rows] += 0.3 * np.clip(res[fit].sum() / max((p * (1 - p)).sum(), 1e-2), -4, 4)
    return list(found)


def rule_matrix(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, j] *= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on the mean log loss plus ``penalty`` times the L1 norm."""
    n = len(y)
    mean = a.mean(axis=0)
    c = a - mean
    v = np.ones(a.shape[1], np.float32) / max(1, a.shape[1]) ** 0.5
    for _ in range(20):
        v = c.T @ (c @ v)
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    step = 1 / (norm / (4 * n) * 1.05 + 0.25)
    w, b = np.zeros(a.shape[1], np.float32), 0.0
    u, ub, t = w, b, 1.0
    for _ in range(steps):
        r = (_sigmoid(c @ u + ub) - y).astype(np.float32)
        nw = u - step * (c.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb, nt = ub - step * float(r.mean()), (1 + (1 + 4 * t * t) ** 0.5) / 2
        u, ub = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b - float(mean @ w)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 5e-4) -> RuleModel:
    """Rules and weights from statistics ``x`` and labels ``y`` (0 or 1)."""
    if len(y) == 0 or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 1.0
        return RuleModel((), (), 30.0 if rate == 1 else -30.0)
    rules = tree_rules(x, y, trees, depth)
    if not rules:
        return RuleModel((), (), float(np.log(y.mean() / (1 - y.mean()))))
    w, b = lasso_logistic(rule_matrix(rules, x), y, penalty)
    keep = np.flatnonzero(np.abs(w) > 1e-3)
    return RuleModel(tuple(rules[j] for j in keep), tuple(float(w[j]) for j in keep), float(b))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    rows = training_rows(docs, labels, "quality", sample)
    stats = statistics_column(docs, F.col("text"))
    got = rows.select(stats.alias("s"), "label").select("s.*", "label").toArrow()
    x = np.stack([got.column(s).to_numpy() for s in STATISTICS], axis=1) if got.num_rows else np.empty((0, len(STATISTICS)))
    y = got.column("label").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))   # the fit does not depend on the order in which rows arrive
    return fit_rules(x[order], y[order])


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 at REJECT_BELOW and above)."""
    model = train(docs, labels, sample)
    measured = docs.select("doc_id", statistics_column(docs, F.col("text")).alias("stats"))
    return (measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("stats")).alias("score"))
            .withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int")))


def keep_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier does not reject, all columns kept."""
    model = train(docs, labels, sample)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_llm_row")
    scored = docs.select(own, statistics_column(docs, F.col("text")).alias("_llm_stats"))
    return scored.where(model.column(F.col("_llm_stats")) >= REJECT_BELOW).select("_llm_row.*")
