"""Exact, order-independent money and ratio arithmetic on whole cents.

Amounts are doubles holding at most two decimals. Sums run on two bigint halves of the
cent value: they stay in whole-stage codegen, give the same result in any row order, and
cannot overflow below 2^43 rows of the largest amount. (Summing ``cast(x as decimal)``
is exact too, but converts every row through text and measured about 6x slower.)
Averages, rates and shares round half up in integers, so no binary fraction decides a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

_HALF_BITS = 20
_WIDE = "decimal(38,0)"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    """Whole cents of an amount with two decimals."""
    return F.floor(_column(amount) * F.lit(100.0) + F.lit(0.5))


def from_cents(value: Column) -> Column:
    return value.cast("double") / F.lit(100.0)


def total_cents(amount: Column | str) -> Column:
    """Aggregate: exact sum in cents as decimal(38,0)."""
    c = cents(amount)
    high = F.sum(F.shiftright(c, _HALF_BITS))
    low = F.sum(c.bitwiseAND(F.lit((1 << _HALF_BITS) - 1).cast("bigint")))
    return high.cast(_WIDE) * F.lit(1 << _HALF_BITS).cast("decimal(8,0)") + low.cast(_WIDE)


def half_up(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half up to a whole number; both non-negative."""
    n, d = numerator.cast(_WIDE), F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))
    return F.call_function("div", n * F.lit(2) + d, d * F.lit(2))


def money_sum(amount: Column | str) -> Column:
    return from_cents(total_cents(amount))


def money_avg(amount: Column | str) -> Column:
    return from_cents(half_up(total_cents(amount), F.count(_column(amount))))


def count_avg(number: Column | str) -> Column:
    """Average of a whole-number column, two decimals."""
    return from_cents(half_up(F.sum(_column(number)) * F.lit(100), F.count(_column(number))))


def percent(part: Column, whole: Column, decimals: int = 2) -> Column:
    scale = 10**decimals
    return half_up(part.cast(_WIDE) * F.lit(100 * scale), whole).cast("double") / F.lit(float(scale))


def share_of_total(count: Column | str, decimals: int = 2) -> Column:
    """Percent of the column's total. Use on grouped rows, never on detail rows."""
    c = _column(count)
    return percent(c, F.sum(c).over(Window.partitionBy()), decimals)
