"""Ratios that round the way decimal arithmetic does.

Numerator and denominator stay exact (integers, or decimals of up to four
places) and become whole numbers before one single division of doubles, so a
tie such as 10.015 still rounds half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole(value: Column) -> Column:
    """The value in units of 0.0001, as a double; exact below 2^53 units."""
    return (value.cast("decimal(33,4)") * 10000).cast("double")


def ratio(num: Column, den: Column, scale: int | None = None) -> Column:
    """``num / den``; NULL when the denominator is zero or NULL."""
    out = F.try_divide(_whole(num), _whole(den))
    return out if scale is None else F.round(out, scale)


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """Percentage of ``den``; 0 unless the denominator is positive."""
    return F.when(den > 0, ratio(num * 100, den, scale)).otherwise(F.lit(0.0))


def mean(num: Column, den: Column, scale: int | None = None) -> Column:
    """``num / den``; 0 unless the denominator is positive."""
    return F.when(den > 0, ratio(num, den, scale)).otherwise(F.lit(0.0))


def growth_pct(value: Column, previous: Column, scale: int = 2) -> Column:
    """Percentage change against the previous value; 0 unless that is positive."""
    return pct(value - previous, previous, scale)
