"""Money, rounding and guarded ratios.

Money columns are doubles at the edges. Double sums depend on the order in which
tasks finish, which flips half-way rounding between two runs of the same job, so
sums run over whole billionths in a long (exact, codegen, map-side combinable) and
turn back into a double once. A sum beyond 9.2e9 currency units raises (ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNIT = 1e9


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_units(x) -> Column:
    return F.rint(_c(x) * F.lit(UNIT)).cast("long")


def from_units(x) -> Column:
    return _c(x) / F.lit(UNIT)


def sum_money(x) -> Column:
    return from_units(F.sum(to_units(x)))


def sum_if(condition: Column, x) -> Column:
    return F.sum(F.when(condition, _c(x)).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long"))


def half_even(x, digits: int = 0) -> Column:
    """Float rounding to even (column-store engines and Python): scale, rint, unscale."""
    scale = F.lit(float(10**digits))
    return F.rint(_c(x) * scale) / scale


def half_up(x, digits: int = 0) -> Column:
    """Rounding away at the half, for non-negative measures."""
    scale = F.lit(float(10**digits))
    return F.floor(_c(x) * scale + F.lit(0.5)).cast("double") / scale


def hundredths(x, divisor: float) -> Column:
    """``round(x / divisor, 2)`` kept as whole hundredths so that sums stay exact."""
    return F.rint(_c(x) / F.lit(float(divisor)) * F.lit(100.0)).cast("long")


def ratio(num, den) -> Column:
    """NULL instead of an error when the denominator is zero or missing."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_or_zero(num, den) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def pct_change(cur, prev) -> Column:
    return ratio(_c(cur) - _c(prev), _c(prev)) * F.lit(100.0)


def zero_if_missing(x) -> Column:
    """NULL and NaN to zero."""
    return F.coalesce(F.nanvl(_c(x).cast("double"), F.lit(0.0)), F.lit(0.0))


def truncated(x) -> Column:
    """Drop the fraction, as an integer conversion does."""
    return _c(x).cast("long")


def short_decimal(x) -> Column:
    """Text of a two-decimal double the way scripting languages print it: 0.5, 12.0."""
    fixed = _c(x).cast("decimal(24,2)").cast("string")
    return F.regexp_replace(fixed, r"(\.\d)0$", "$1")


def whole_share(part, whole) -> Column:
    """Percentage with four decimals of two whole numbers, rounded half-up on exact
    decimals: six decimals first, then times 100."""
    num = _c(part).cast("decimal(18,0)")
    den = _c(whole).cast("decimal(18,0)")
    return (F.round(F.try_divide(num, den), 6) * F.lit(100)).cast("double")
