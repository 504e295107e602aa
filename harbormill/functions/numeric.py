"""Rounding, ratios and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harbormill.functions.text import strip


def money(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal, so that sums do not depend on the order of the rows."""
    return c.cast(f"decimal({precision},{scale})")


def rounded(c: Column, scale: int, rounding: str = "half_up") -> Column:
    """Decimal rounding: half away from zero (SQL) or half to even (Python)."""
    if rounding not in ("half_up", "half_even"):
        raise ValueError(f"unknown rounding {rounding!r}")
    return F.round(c, scale) if rounding == "half_up" else F.bround(c, scale)


def ratio(num: Column, den: Column, scale: int = 4, rounding: str = "half_up") -> Column:
    """``num / den`` as an exact decimal quotient; 0 when the divisor is not positive."""
    # decimal(20,2) / decimal(20,2) keeps 18 fractional digits before rounding
    quotient = num.cast("decimal(20,2)") / F.when(den > 0, den.cast("decimal(20,2)"))
    return F.coalesce(rounded(quotient, scale, rounding), F.lit(0)).cast(f"decimal(20,{scale})")


def mean_of(total: Column, count: Column, scale: int = 2) -> Column:
    """Rounded mean from an exact decimal total; null when nothing was counted."""
    quotient = total / F.when(count > 0, count).cast("decimal(20,0)")
    return rounded(quotient, scale).cast(f"decimal(22,{scale})")


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``100 * part / whole`` as double, rounded half to even, 0.0 for an empty whole."""
    quotient = (part * 100).cast("decimal(24,0)") / F.when(whole > 0, whole).cast("decimal(20,0)")
    return F.coalesce(F.bround(quotient, scale).cast("double"), F.lit(0.0))


def finite(c: Column) -> Column:
    """Infinite and NaN values become null."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def divide(num: Column, den: Column) -> Column:
    """IEEE division on doubles: x/0 is signed infinity, 0/0 and null operands give null."""
    num, den = num.cast("double"), den.cast("double")
    return (
        F.when(den != 0, F.try_divide(num, den))
        .when((den == 0) & (num > 0), F.lit(float("inf")))
        .when((den == 0) & (num < 0), F.lit(float("-inf")))
    )


def number_or_zero(c: Column, dtype: str = "bigint") -> Column:
    """Text to number; anything unreadable counts as zero."""
    return F.coalesce(c.try_cast("double").try_cast(dtype), F.lit(0).cast(dtype))


def flag_from_text(c: Column) -> Column:
    """0/1 text to boolean; unreadable text is false."""
    return number_or_zero(c) != 0


def price_or_null(c: Column) -> Column:
    """Price text to decimal; blank or unreadable text is null."""
    return F.nullif(strip(c), F.lit("")).try_cast("decimal(8,2)")


def whole_number(c: Column) -> Column:
    """Text such as '0.25' to an integer, rounded half up; unreadable text is null."""
    return F.round(c.try_cast("decimal(18,6)"), 0).cast("int")


def blank_as(c: Column, default: str) -> Column:
    """Replace the empty string before a cast."""
    return F.when(c == "", F.lit(default)).otherwise(c)


def cents(c: Column, scale: int = 2) -> Column:
    """Integer cents to currency units."""
    return F.round(c.cast("decimal(18,4)") / 100, scale).cast(f"decimal(18,{scale})")
