"""Row counts of many tables in one result."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, cnt) for each table."""
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(n).alias("name"), "cnt") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
