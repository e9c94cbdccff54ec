"""Mixing sources to target weights by temperature, in DataFrame and SQL functions only.

A source with token share ``s`` gets weight ``s**a / sum(s**a)``.  The exponent
``a`` in [0, 1] is the one nearest 1 (the natural shares) at which the entropy of
the weights reaches ``entropy_share`` of its maximum; if some source would then be
read more than ``most_epochs`` times, ``a`` is raised to where that limit holds.
Both are found by interval search: each round one aggregate over the sources
evaluates ``POINTS`` exponents and keeps the interval with the crossing, so only
one row of numbers per round reaches the driver, however many sources there are.

The weights become documents by passes: a source with a budget of ``target``
tokens is read ``target // tokens`` times in full, then once in part.  Each pass
is a permutation by MD5 of (seed, pass, doc_id).  The first three hex digits are
the block; tokens are summed per block, block sums accumulate along the
permutation, and within a block documents accumulate in key order, so the running
total is exact and no task sees more than 1/4096 of a source.  The partial pass
takes the documents that start before the rest of the budget is used up.

Defined results: null text has no tokens.  A null source is a source of its own.
Sources without tokens have weight 0 and give nothing.  Null doc_ids are permuted
by the digest of their text.  Rows that repeat are each part of the mix.  An empty
table gives an empty mix.  If even the natural shares break the repetition limit
(a budget above ``most_epochs`` times the corpus), the natural shares are used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import columns_as, cut

#: Exponents evaluated at once; eight rounds narrow the interval to 1e-10.
POINTS, ROUNDS = 16, 8
WORD = r"[^\x20\x09-\x0D]+"


def source_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, n_tokens) of each row; ``key`` names the source, null included."""
    d = columns_as(docs, "doc_id", "source", "text")
    return d.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("key"),
                    F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit("null")).alias("name"),
                    F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))


def _evaluate(shares: DataFrame, budget: float, points: list[float]) -> list[tuple[float, float]]:
    """(entropy, largest repetition) of the tempered weights at each exponent."""
    aggs = []
    for i, a in enumerate(points):
        p = F.pow("share", F.lit(a))
        aggs += [F.sum(p).alias(f"z{i}"), F.sum(p * a * F.log("share")).alias(f"l{i}"), F.max(p / F.col("tokens")).alias(f"r{i}")]
    row = shares.agg(*aggs).select(*[F.log(f"z{i}") - F.col(f"l{i}") / F.col(f"z{i}") for i in range(len(points))],
                                   *[budget * F.col(f"r{i}") / F.col(f"z{i}") for i in range(len(points))]).first()
    return list(zip(row[: len(points)], row[len(points) :], strict=True))


def _crossing(shares: DataFrame, budget: float, holds, rising: bool) -> float:
    """The exponent in [0, 1] at which ``holds(entropy, repetition)`` changes.

    ``rising``: it holds from some exponent upwards (the smallest such is sought),
    else up to some exponent (the largest such).
    """
    lo, hi = 0.0, 1.0
    at_lo, at_hi = (holds(*x) for x in _evaluate(shares, budget, [lo, hi]))
    if rising:
        if at_lo or not at_hi:
            return 0.0 if at_lo else 1.0
    elif at_hi or not at_lo:
        return 1.0 if at_hi else 0.0
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
        ok = [holds(*x) for x in _evaluate(shares, budget, points)]
        edges = [lo, *points, hi]
        first = next((i for i, x in enumerate(ok) if x == rising), POINTS)
        lo, hi = edges[first], edges[first + 1]
    return hi if rising else lo


def mixing_weights(tokens: DataFrame, budget: int | None, entropy_share: float, most_epochs: float) -> DataFrame:
    """(key, tokens, weight, target) of each source with tokens; ``tokens`` as from source_tokens."""
    sizes = cut(tokens.groupBy("key").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "sources")
    total, n = sizes.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    total, n = total or 0, n or 0
    budget = total if budget is None else budget
    shares = sizes.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    exponent = 1.0
    if n > 1:
        goal = F.log(F.lit(float(n))) * entropy_share
        goal = sizes.sparkSession.range(1).select(goal).first()[0]
        level = _crossing(shares, float(budget), lambda entropy, _: entropy >= goal, rising=False)
        bound = _crossing(shares, float(budget), lambda _, repetition: repetition <= most_epochs, rising=True)
        exponent = max(level, bound)
    powered = shares.withColumn("power", F.pow("share", F.lit(exponent)))
    norm = powered.agg(F.sum("power").alias("norm"))   # one row
    return (powered.crossJoin(F.broadcast(norm)).withColumn("weight", F.col("power") / F.col("norm"))
            .select("key", "tokens", "weight", F.floor(F.col("weight") * float(budget) + 0.5).cast("long").alias("target")))


def mix_sources(docs: DataFrame, budget: int | None = None, entropy_share: float = 0.999, most_epochs: float = 4.0, seed: int = 1) -> DataFrame:
    """The mix as rows (doc_id, source, epoch, n_tokens, weight, position).

    ``position`` in [0, 1) is how far the row lies in its source's budget; ordering
    by it interleaves the sources in proportion.  ``budget``: tokens in all (the
    corpus's size by default).
    """
    tokens = cut(source_tokens(docs), "tokens")
    weights = cut(mixing_weights(tokens, budget, entropy_share, most_epochs), "weights")
    plan = (weights.withColumn("full", F.floor(F.col("target") / F.col("tokens")).cast("long"))
            .withColumn("rest", F.col("target") - F.col("full") * F.col("tokens"))
            .withColumn("last", F.when(F.col("rest") > 0, F.col("full")).otherwise(F.col("full") - 1)).where("last >= 0")
            .select("key", "tokens", "weight", "target", "full", "rest", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("epoch")))
    dealt = (tokens.join(plan, "key")
             .withColumn("order", F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", "name").cast("binary")))
             .withColumn("block", F.substring("order", 1, 3)))
    blocks = dealt.groupBy("key", "epoch", "block").agg(F.sum("n_tokens").alias("size"))
    along = Window.partitionBy("key", "epoch").orderBy("block")   # at most 4096 rows
    starts = blocks.select("key", "epoch", "block", (F.sum("size").over(along) - F.col("size")).alias("block_start"))
    inside = Window.partitionBy("key", "epoch", "block").orderBy("order", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    placed = (dealt.withColumn("before", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(starts, ["key", "epoch", "block"])
              .withColumn("start", F.col("block_start") + F.col("before")))
    return (placed.where((F.col("epoch") < F.col("full")) | (F.col("start") < F.col("rest")))
            .select("doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "n_tokens", F.round("weight", 6).alias("weight"),
                    F.round((F.col("epoch") * F.col("tokens") + F.col("start")) / F.col("target"), 6).alias("position")))


#: The same mix in DuckDB, for a view of documents named by ``docs``.
def oracle(docs: str = "documents", entropy_share: float = 0.999, most_epochs: float = 4.0, seed: int = 1) -> str:
    def search(name: str, holds: str, rising: bool) -> str:
        better, worse = ("lo", "mid"), ("mid", "hi")
        yes, no = (better, worse) if rising else (worse, better)
        end = "hi" if rising else "lo"
        return f"""
{name}(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN {yes[0]} ELSE {no[0]} END, CASE WHEN ok THEN {yes[1]} ELSE {no[1]} END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, (SELECT {holds} FROM curve((lo + hi) / 2)) AS ok FROM {name} WHERE i < 40)
),
{name}_end AS (SELECT CASE WHEN (SELECT {holds} FROM curve({0 if rising else 1})) THEN {0 if rising else 1}.0
  WHEN NOT (SELECT {holds} FROM curve({1 if rising else 0})) THEN {1 if rising else 0}.0
  ELSE (SELECT {end} FROM {name} WHERE i = 40) END AS a)"""

    def curve(sql: str) -> str:
        body = ("(SELECT ln(sum(pow(share, {a}))) - sum(pow(share, {a}) * {a} * ln(share)) / sum(pow(share, {a})) AS entropy, "
                "(SELECT sum(tokens) FROM s) * max(pow(share, {a}) / tokens) / sum(pow(share, {a})) AS repetition, count(*) AS n FROM s)")
        return re.sub(r"curve\((\(lo \+ hi\) / 2|[01])\)", lambda m: body.format(a=f"({m[1]})"), sql)

    return curve(f"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS key, coalesce(doc_id::VARCHAR, md5(text), 'null') AS name,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM {docs}
),
g AS (SELECT key, sum(n_tokens)::BIGINT AS tokens FROM t GROUP BY key HAVING sum(n_tokens) > 0),
s AS (SELECT key, tokens, tokens / (SELECT sum(tokens) FROM g) AS share FROM g),
{search("up", f"entropy >= ln(n) * {entropy_share}", False)},
{search("down", f"repetition <= {most_epochs}", True)},
w AS (
  SELECT key, tokens, pow(share, a) / (SELECT sum(pow(share, a)) FROM s) AS weight
  FROM s, (SELECT CASE WHEN (SELECT count(*) FROM s) > 1 THEN greatest(up_end.a, down_end.a) ELSE 1.0 END AS a FROM up_end, down_end)
),
p AS (
  SELECT key, tokens, weight, target, target // tokens AS whole, target - (target // tokens) * tokens AS rest
  FROM (SELECT *, floor(weight * (SELECT sum(tokens) FROM g) + 0.5)::BIGINT AS target FROM w)
),
e AS (
  SELECT t.*, p.tokens, p.weight, p.target, p.whole, p.rest, r.epoch,
         sum(n_tokens) OVER (PARTITION BY t.key, r.epoch ORDER BY md5('{seed}:' || r.epoch || ':' || t.name), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM t JOIN p USING (key), unnest(range(0, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS r(epoch)
)
SELECT doc_id, source, epoch::INTEGER AS epoch, n_tokens::BIGINT AS n_tokens, round(weight, 6) AS weight,
       round((epoch * tokens + start) / target, 6) AS position
FROM e WHERE epoch < whole OR start < rest
""")
