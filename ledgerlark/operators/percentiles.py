"""Exact percentiles per group by rank selection in two passes.

Pass one counts the values of each group by bucket, ``BUCKETS`` per doubling of the value, so a task sends at most some hundred narrow rows per group,
however many values it read.  Running counts over the buckets name those that hold a
wanted rank.  Pass two reads the values again, keeps those in named buckets (a per cent
or two) and counts them one by one; the running counts inside a bucket, on top of what
lies before it, give the values at the wanted ranks.

Nothing but (group, value) travels, and no task holds a group's values.  Other
measures of the same groups are a separate aggregate, see ``with_percentiles``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per doubling of the value.
BUCKETS = 64
PERCENTILE_SCALE = 6


class Percentile(NamedTuple):
    """``name``: output column; ``fraction`` in [0, 1]; ``where``: a boolean column name, or None for all values."""

    name: str
    fraction: float
    where: str | None = None


def percentile_value(c):
    """Interpolated percentile published at 6 decimals.

    The exact value of a linear-interpolated percentile of integers is a short
    decimal (e.g. ``12141.8``); engines differ only in float noise from their
    interpolation formula, which the rounding removes.
    """
    return F.round(c, PERCENTILE_SCALE)


def bucket(v: Column) -> Column:
    """Bucket of an integer: the logarithm of its distance from zero, in steps, with its sign.

    Buckets ascend with the values, since each step of the formula does (``log1p`` is the strict one of the JVM).
    ``v`` stands in it twice only: Catalyst copies it into join keys and filters with all that ``v`` is made of.
    """
    distance = F.log1p(F.abs(v.cast("double")))
    return (F.signum(v.cast("double")) * F.floor(distance * F.lit(BUCKETS / math.log(2)))).cast("int")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, wanted: Sequence[Percentile]) -> DataFrame:
    """One row per group of ``keys`` (null is a group) with the ``wanted`` linear-interpolated percentiles.

    ``value`` is an integer column, nulls do not count.  A percentile without any value is null.
    Groups are few beside the rows (days, models): their wanted buckets, at most two per percentile and
    group, are broadcast.
    """
    conditions = list(dict.fromkeys(p.where for p in wanted))
    n = {c: f"_n{i}" for i, c in enumerate(conditions)}          # values of a bucket under each condition
    before, total = ({c: f"_{what}{i}" for i, c in enumerate(conditions)} for what in ("before", "total"))
    # No filter on the value and no plain equality on its bucket: Catalyst would push their null tests, spelled out
    # down to the raw columns, below every join that ``rows`` is made of.
    known = rows.select(
        *keys, F.col(value).alias("_v"), bucket(F.col(value)).alias("_bucket"), *[F.col(c) for c in conditions if c])

    def counted(c: str | None) -> Column:
        return (F.count_if(F.col(c) & F.col("_v").isNotNull()) if c else F.count("_v")).alias(n[c])

    def rank(p: Percentile, which: int) -> Column:
        """Rank of the lower (0) or upper (1) neighbour of the percentile among its values, from 0."""
        low = F.floor((F.col(total[p.where]) - 1) * F.lit(p.fraction)).cast("long")
        return low if which == 0 else F.least(low + 1, F.col(total[p.where]) - 1)

    histogram = known.groupBy(*keys, "_bucket").agg(*[counted(c) for c in conditions])
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.select(
        *keys, "_bucket", *[F.col(n[c]) for c in conditions],
        *[F.coalesce(F.sum(n[c]).over(so_far), F.lit(0)).alias(before[c]) for c in conditions],
        *[F.sum(n[c]).over(group).alias(total[c]) for c in conditions])

    def holds(p: Percentile, which: int, start: Column, count: Column) -> Column:
        return (rank(p, which) >= start) & (rank(p, which) < start + count)

    named = placed.where(reduce(or_, [holds(p, i, F.col(before[p.where]), F.col(n[p.where])) for p in wanted for i in (0, 1)]))
    named = named.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_b"),
                         *[F.col(x) for c in conditions for x in (before[c], total[c])])
    hit = known.join(F.broadcast(named), _same(known, named, keys) & known["_bucket"].eqNullSafe(named["_b"]))
    values = hit.groupBy(*keys, "_bucket", *[x for c in conditions for x in (before[c], total[c])], "_v").agg(*[counted(c) for c in conditions])
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = {c: f"_start{i}" for i, c in enumerate(conditions)}
    ranked = values.withColumns({start[c]: F.col(before[c]) + F.coalesce(F.sum(n[c]).over(inside), F.lit(0)) for c in conditions})
    at = {(p, i): F.max(F.when(holds(p, i, F.col(start[p.where]), F.col(n[p.where])), F.col("_v"))).alias(f"_{p.name}_{i}") for p in wanted for i in (0, 1)}
    # Every bucket of a group knows the group's totals, so one of them will do.
    ends = ranked.groupBy(*keys).agg(*at.values(), *[F.max(total[c]).alias(total[c]) for c in conditions])

    def between(p: Percentile) -> Column:
        place = (F.col(total[p.where]) - 1) * F.lit(p.fraction)
        low, high = F.col(f"_{p.name}_0").cast("double"), F.col(f"_{p.name}_1").cast("double")
        return percentile_value(low + (high - low) * (place - F.floor(place))).alias(p.name)

    return ends.select(*keys, *[between(p) for p in wanted])


def with_percentiles(groups: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, wanted: Sequence[Percentile]) -> DataFrame:
    """``groups`` (one row per group, e.g. its additive measures) with the percentiles of ``rows`` joined on."""
    p = exact_percentiles(rows, keys, value, wanted).withColumnsRenamed({k: f"_{k}" for k in keys})
    return groups.join(p, _same(groups, p, keys), "left").drop(*[f"_{k}" for k in keys])
