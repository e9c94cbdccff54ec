"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. *Terms.*  Words and their beginnings and endings in a bounded labelled sample are
   counted by class with Spark; the ones that speak for a class become terms, next
   to a short fixed lexicon.
2. *Voters.*  Every strong term is a lexicon voter; patterns (number and density of
   matched terms, shouting, repeated marks, a text with no term) and the annotation
   itself vote too.  A voter says toxic, clean or abstains.
3. *Label model.*  Expectation maximisation over a latent class estimates how often
   each voter says what for either class.  Correlations that remain between voters
   given the class are estimated as well, and correlated voters share their weight.
4. *Classifier.*  L2-penalised logistic regression on term counts, fitted to the
   posterior labels.
5. All documents are scored in one pass: an Aho-Corasick automaton over the terms
   reads each whole text once.

The sample is at most ``SAMPLE`` documents; what reaches the driver is its term
counts above ``LEAST`` occurrences and one row of term matches per sampled text.
Defined results: null and empty texts match no term and get the score of such
texts.  Without usable labels only the fixed lexicon votes.  Repeated rows are
each scored; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import arrow_map, cut, held_out, ship_package
from ledgerlark.llm.labelled import training_rows

#: Labelled documents used for training, at most.
SAMPLE = 8_000
#: A term must occur in this many sampled documents of the class it speaks for.
LEAST = 3
#: Terms kept, by strength.
TERMS = 800
#: The strongest terms that vote each for itself.
VOTING_TERMS = 120

# A small general lexicon of insults.
LEXICON = ("idiot", "stupid", "moron", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "dumb", "imbecile", "hate", "ugly", "shut up", "dummkopf", "abschaum", "imbécile", "ordure", "estúpido", "basura")

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str | None) -> str:
    """Lower case, runs of anything but letters as one space, a space at both ends."""
    return f" {_NOT_LETTERS.sub(' ', (text or '').lower()).strip()} "


def _parts(word: str) -> list[str]:
    """The term forms of a word: itself, its beginnings and its endings."""
    n = len(word)
    return [f" {word} ", *[f" {word[:i]}" for i in (4, 5, 6) if i < n], *[f"{word[-i:]} " for i in (4, 5) if i < n]]


def count_terms(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many texts of either label each term form occurs."""
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        for batch in batches:
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = {w for w in set(normalise(text).split()) if len(w) <= 40}
                counts[label].update({p for w in words for p in _parts(w)})
            terms = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
                                              pa.array([counts[0][t] for t in terms], pa.int64())], schema=schema)

    return arrow_map(rows, run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_terms(counts: DataFrame, toxic: int, clean: int) -> list[str]:
    """The terms that speak most for toxic, with the lexicon.

    Strength is the lower end of the log odds of a term, so that neither rare nor
    evenly spread terms come in.
    """
    chosen: list[str] = [f" {w} " for w in LEXICON]
    if toxic and clean:
        p, q = (F.col("toxic") + 0.5) / (toxic + 1), (F.col("clean") + 0.5) / (clean + 1)
        strength = F.log(p / q) - 2.0 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
        best = (counts.where(F.col("toxic") >= LEAST).withColumn("strength", strength).where("strength > 1")
                .orderBy(F.desc("strength"), "term").limit(TERMS))
        chosen += [r.term for r in best.select("term").toLocalIterator()]
    return list(dict.fromkeys(chosen))


def _automaton(terms: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        a.add_word(t, i)
    a.make_automaton()
    return a


def match(text: str | None, automaton) -> tuple[Counter, np.ndarray]:
    """Term counts of a text and its pattern numbers: words, shouted share, repeated marks."""
    plain = normalise(text)
    hits = Counter(i for _, i in automaton.iter(plain))
    raw = text or ""
    words = plain.count(" ") - 1 if plain.strip() else 0
    shout = sum(map(raw.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / max(len(raw), 1)
    marks = raw.count("!!") + raw.count("??")
    return hits, np.array([words, shout, marks], float)


def votes(counts: np.ndarray, patterns: np.ndarray, label: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """Texts by voters: 1 toxic, -1 clean, 0 abstains.  ``strong``: the terms that vote by themselves."""
    hit, words = counts.sum(axis=1), np.maximum(patterns[:, 0], 1)
    columns = [np.where(counts[:, j] > 0, 1, 0) for j in strong]
    columns += [
        np.where((counts > 0).sum(axis=1) >= 3, 1, 0),
        np.where(hit / words > 0.02, 1, 0),
        np.where(hit == 0, -1, 0),
        np.where((hit <= 1) & (words > 200), -1, 0),
        np.where((patterns[:, 1] > 0.3) & (hit > 0), 1, 0),
        np.where((patterns[:, 2] > 2) & (hit > 0), 1, 0),
        np.where(label > 0, 1, -1),
    ]
    return np.stack(columns, axis=1)


def label_model(v: np.ndarray, prior: float, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of toxic, table [class, vote, voter], weight of each voter).

    The class is latent.  ``prior`` starts the rates of the last voter (the
    annotation) as mostly right.  Each round re-estimates the vote tables, then the
    correlation of every two voters given the class: a voter's log odds count
    ``1 / (1 + sum of its positive correlations)``.
    """
    n, m = v.shape
    seen = np.stack([(v == x).astype(float) for x in (-1, 0, 1)])       # vote, text, voter
    post = np.where(v[:, -1] > 0, 0.95, 0.05 * prior + 0.01)
    weight, table = np.ones(m), np.empty((2, 3, m))
    for _ in range(rounds):
        for c, p in enumerate((1 - post, post)):
            table[c] = (np.einsum("t,xtm->xm", p, seen) + 0.5) / (p.sum() + 1.5)
        odds = np.log(table[1] / table[0])                               # vote, voter
        z = np.einsum("xtm,xm->t", seen, odds * weight) + np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        rest = np.zeros((m, m))
        for c, p in enumerate((1 - new, new)):                           # correlation within either class
            mean = p @ v / max(p.sum(), 1e-9)
            d = (v - mean) * np.sqrt(p)[:, None]
            cov = d.T @ d / max(p.sum(), 1e-9)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            rest += 0.5 * cov / sd[:, None] / sd[None, :]
        np.fill_diagonal(rest, 0)
        weight = 1 / (1 + np.maximum(rest - 0.1, 0).sum(axis=1))
        weight[-1] = 1.0   # the annotation is an observation of its own, not one more term
        if np.abs(new - post).max(initial=0) < 1e-4:
            post = new
            break
        post = new
    return post, table, weight


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated gradient for soft labels ``y`` with an L2 penalty on the weights."""
    n = len(y)
    step = 4 / (float((x**2).sum(axis=1).max(initial=0)) * 0.5 + 1 + 4 * ridge)
    w, b = np.zeros(x.shape[1]), float(np.log(np.clip(y.mean(), 1e-4, 1 - 1e-4) / np.clip(1 - y.mean(), 1e-4, 1)))
    u, ub, t = w, b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-np.clip(x @ u + ub, -30, 30))) - y
        nw, nb = u - step * (x.T @ r / n + ridge * u), ub - step * float(r.mean())
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        u, ub = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def features(counts: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """What the classifier sees: terms damped, and how many and how dense they are."""
    hit = counts.sum(axis=1, keepdims=True)
    words = np.maximum(patterns[:, :1], 1)
    return np.hstack([np.minimum(counts, 2) / 2, np.minimum((counts > 0).sum(axis=1, keepdims=True), 6) / 2,
                      np.minimum(100 * hit / words, 5) / 2, (hit == 0).astype(float)])


@dataclass(frozen=True)
class ToxicityModel:
    terms: list[str]
    weights: list[float]
    bias: float

    def score(self, texts: list[str | None], automaton) -> np.ndarray:
        w, out = np.asarray(self.weights), np.empty(len(texts))
        for i, text in enumerate(texts):
            hits, pat = match(text, automaton)
            total = sum(hits.values())
            z = self.bias + sum(w[j] * min(c, 2) / 2 for j, c in hits.items())
            z += w[-3] * min(len(hits), 6) / 2 + w[-2] * min(100 * total / max(pat[0], 1), 5) / 2 + w[-1] * (total == 0)
            out[i] = z
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    rows = cut(training_rows(docs, labels, "toxic", sample), "toxic-sample")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}   # two rows
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    terms = choose_terms(count_terms(rows), toxic, clean)
    schema = pa.schema([("label", pa.int32()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("patterns", pa.list_(pa.float64()))])

    def run(batches):
        automaton = _automaton(terms)
        for batch in batches:
            found = [match(t, automaton) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int32()), pa.array([list(h) for h, _ in found], schema.field(1).type),
                 pa.array([list(h.values()) for h, _ in found], schema.field(2).type), pa.array([p for _, p in found], schema.field(3).type)], schema=schema)

    got = arrow_map(rows, run, "label int, terms array<int>, counts array<int>, patterns array<double>").toArrow()
    n = got.num_rows
    counts, y = np.zeros((n, len(terms))), got.column("label").to_numpy().astype(float)
    for i, (js, cs) in enumerate(zip(got.column("terms").to_pylist(), got.column("counts").to_pylist(), strict=True)):
        counts[i, js] = cs
    patterns = np.array(got.column("patterns").to_pylist(), float).reshape(n, 3)
    if not toxic or not clean:   # nothing to learn from: the fixed lexicon decides
        return ToxicityModel(terms, [3.0] * len(terms) + [1.0, 0.0, -1.0], -3.0)
    support = (counts > 0).sum(axis=0)
    strong = np.flatnonzero(support >= LEAST)[:VOTING_TERMS]   # terms come strongest first, after the lexicon
    post, _, _ = label_model(votes(counts, patterns, y, strong), toxic / n)
    w, b = logistic(features(counts, patterns), post)
    return ToxicityModel(terms, [float(x) for x in w], float(b))


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 at 0.5 and above)."""
    model = train(docs, labels, sample)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most TERMS terms and weights
    held: dict = {}

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        if "automaton" not in held:
            held["automaton"] = _automaton(m.terms)
        return pa.array(m.score(texts.to_pylist(), held["automaton"]))

    return (docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
