"""Window measures and day selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.ratios import growth_pct, ratio


def trailing_mean(value: Column, partition: Sequence[str], order: str, rows: int = 7, scale: int = 2) -> Column:
    """Mean of the last ``rows`` rows (not calendar days), NULLs left out."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return ratio(F.sum(value).over(w), F.count(value).over(w), scale)


def growth_vs_prev(value: Column, partition: Sequence[str], order: str, scale: int = 2) -> Column:
    """Percentage change against the previous row; 0 on the first row or after a zero."""
    w = Window.partitionBy(*partition).orderBy(order)
    return growth_pct(value, F.lag(value, 1, 0).over(w), scale)


def running_sum(value: Column, partition: Sequence[str], order: str) -> Column:
    w = Window.partitionBy(*partition).orderBy(order)
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def share_of_total(value: Column, partition: Sequence[str] = (), scale: int = 2) -> Column:
    """Percentage of the partition's sum; use on small aggregates only."""
    return ratio(value * 100, F.sum(value).over(Window.partitionBy(*partition)), scale)


def latest_nonempty_day(df: DataFrame, cond: Column, day: str = "dt") -> Column:
    """The latest day with a row that meets ``cond``, as a scalar subquery.

    ``df.where(F.col("dt") == latest_nonempty_day(df, cond))`` filters on it;
    the filter reaches the scans below and prunes their day partitions.
    """
    return df.where(cond).agg(F.max(day)).scalar()


def retain_window(df: DataFrame, as_of: date | Column, before: int = 30, after: int = 3, day: str = "dt") -> DataFrame:
    """Rows from ``before`` days before ``as_of`` to ``after`` days after it."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of)
    at = at.cast("date")
    return df.where(F.col(day).between(F.date_sub(at, before), F.date_add(at, after)))
