"""Day columns and epoch times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a time; the partition value of raw and fact tables."""
    return ts.cast("date").cast("string")


def day_of(dt: Column) -> Column:
    """Day text to a date; aggregates and reports carry dates."""
    return dt.cast("date")


def epoch_ms(day: Column) -> Column:
    """Milliseconds since the epoch of a day's start in the session zone."""
    return F.unix_timestamp(day.cast("timestamp")) * 1000
