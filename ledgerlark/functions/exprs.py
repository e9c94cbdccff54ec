"""Column-expression helpers shared by every layer.

All helpers return JVM-side ``Column`` expressions (no Python UDFs), so they stay
inside whole-stage codegen.  Several of them exist only to give one meaning to
constructs whose semantics differ between SQL dialects (see SURVEY §2.J):
empty-text casts under ANSI mode, boundary-counting date differences, double
ratios that must not be decimal-rounded, and half-up integer rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """``nullif(trim(x), '')`` - the only safe prelude to an ANSI cast."""
    t = F.trim(col(c))
    return F.when(t != F.lit(""), t)


def text_cast(c: str | Column, dtype: str) -> Column:
    """Cast landing text to ``dtype``; empty text becomes NULL, junk still fails."""
    return blank_to_null(c).cast(dtype)


def lower_trim(c: str | Column) -> Column:
    return F.lower(F.trim(col(c)))


def pick(idx: Column, values: Sequence[str]) -> Column:
    """``values[idx]`` for a 0-based integer column (fixed-domain lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` evaluated in DOUBLE.

    Both operands are cast to double first, so the division is one IEEE
    operation - never a rounded DECIMAL(28,6) as ``bigint * 1.0 / n`` would be.
    """
    d = col(den).cast("double")
    return F.when(d != F.lit(0.0), col(num).cast("double") / d)


def epoch_seconds(ts: str | Column) -> Column:
    return F.unix_timestamp(col(ts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (F05; inputs carry whole seconds)."""
    return epoch_seconds(end) - epoch_seconds(start)


def minute_boundaries_between(start: str | Column, end: str | Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``."""
    return F.floor(epoch_seconds(end) / F.lit(60)) - F.floor(epoch_seconds(start) / F.lit(60))


def days_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in days for DATE columns (F07; argument order as written)."""
    return F.datediff(col(end), col(start))


def week_start(d: str | Column) -> Column:
    """Monday of the week of ``d`` as DATE."""
    return F.trunc(col(d), "week")


def full_day_name(d: str | Column) -> Column:
    """English weekday name, e.g. ``Monday``."""
    return F.date_format(col(d), "EEEE")


def round_half_up_int(c: str | Column) -> Column:
    """Decimal -> INTEGER with half-up rounding (F15); a bare cast would truncate."""
    return F.round(col(c), 0).cast("int")


def count_where(pred: Column) -> Column:
    """``count(*) filter (where pred)`` - NULL predicates do not count."""
    return F.count_if(pred)


def sum_where(pred: Column, value: str | Column) -> Column:
    """``sum(value) filter (where pred)``; NULL when nothing matches."""
    return F.sum(F.when(pred, col(value)))
