"""Rounding and truncation on decimals, so results do not hang on float noise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: list price of one gigabyte-hour, in dollars.
DOLLARS_PER_GB_HOUR = "0.09"
HOURS_PER_MONTH = 24 * 30

# Wide enough for byte counts, exact to a millionth.
EXACT = "decimal(28,6)"


def exact(c: Column) -> Column:
    return c.cast(EXACT)


def micros(c: Column) -> Column:
    """Millionths as a long: sums exactly, and much faster than a wide decimal.

    Holds totals up to nine million million units; beyond that ANSI arithmetic raises.
    """
    return F.round(c * 1000000).cast("long")


def from_micros(c: Column) -> Column:
    return c.cast("double") / 1000000


def whole_and_micros(c: Column) -> tuple[Column, Column]:
    """A number as whole units and millionths, both longs, whose sums stay exact and never meet a wide decimal.

    Values are taken to a millionth, as far as a double of their size resolves it.
    """
    whole = F.floor(c).cast("long")
    return whole, F.round((c - whole) * 1000000).cast("long")


def rounded_total(whole: Column, micros: Column) -> Column:
    """The sum of both parts as a long, half away from zero."""
    rest = F.pmod(micros, F.lit(1000000))
    base = whole + ((micros - rest) / 1000000).cast("long")
    return base + F.when(base >= 0, rest >= 500000).otherwise(rest > 500000).cast("long")


def cents(c: Column) -> Column:
    """A two-place decimal amount in cents, as a long."""
    return (c * 100).cast("long")


def to_int64(c: Column) -> Column:
    """Cast to long rounding half away from zero (a bare cast truncates)."""
    return F.round(c).cast("long")


def trunc2(c: Column) -> Column:
    """Cut a decimal to two places, towards zero."""
    return F.when(c < 0, F.ceil(c, F.lit(2))).otherwise(F.floor(c, F.lit(2))).cast("decimal(28,2)")


def monthly_price(size_gb: Column) -> Column:
    """Monthly recurring revenue of an asset of this size, cut to cents."""
    return trunc2(exact(size_gb) * F.lit(DOLLARS_PER_GB_HOUR).cast("decimal(4,2)") * F.lit(HOURS_PER_MONTH))


def rounded_ratio(total: Column, n: Column) -> Column:
    """total / n to the nearest whole number, 0 when n is 0 or unknown."""
    return F.round(F.coalesce(F.try_divide(total.cast("double"), n), F.lit(0.0)))
