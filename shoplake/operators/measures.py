"""Several sources, one grain: aligned union, sums and exact distinct counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stats:
    """An aggregate per key and day.

    ``types`` gives the measures (name -> type), ``sources`` for each fact some of them as SQL expressions of its columns;
    the others count as 0.  Attributes are carried as the largest non-NULL value; ``distinct`` counts the different
    non-NULL values of a column (name -> column).
    """

    keys: tuple[str, ...]
    attrs: tuple[str, ...]
    types: Mapping[str, str]
    sources: Mapping[str, Mapping[str, str]]
    distinct: Mapping[str, str] = field(default_factory=dict)

    def of(self, *facts: DataFrame) -> DataFrame:
        """The aggregate of whole fact tables, in the order of ``sources``."""
        pairs = list(zip(facts, self.sources.values(), strict=True))
        return union_measures(pairs, self.keys, self.attrs, self.types, self.distinct)


def aligned(
    df: DataFrame,
    measures: Mapping[str, str],
    keys: Sequence[str],
    attrs: Sequence[str],
    types: Mapping[str, str],
    others: Sequence[str] = (),
) -> DataFrame:
    """Rows of one source in the common shape: keys (``dt`` as a date), attributes, measures and other columns as they are."""
    have = set(df.columns)
    key_cols = [f"cast({k} as date) as {k}" if k == "dt" else k for k in keys]
    attr_cols = [a if a in have else f"null as {a}" for a in attrs]
    sums = [f"cast({measures.get(m, '0')} as {t}) as {m}" for m, t in types.items()]
    return df.dropna(subset=list(keys)).selectExpr(*key_cols, *attr_cols, *sums, *others)


def union_measures(
    sources: Sequence[tuple[DataFrame, Mapping[str, str]]],
    keys: Sequence[str],
    attrs: Sequence[str],
    types: Mapping[str, str],
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key with every measure summed over all sources; see :class:`Stats`.

    Rows with a NULL key are left out.  ``dt`` becomes a date.
    """
    others = list(dict.fromkeys((distinct or {}).values()))
    rows = reduce(DataFrame.unionByName, [aligned(df, m, keys, attrs, types, others) for df, m in sources])
    largest = [F.max(a).alias(a) for a in attrs]
    counts = [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
    sums = [F.expr(f"cast(sum({m}) as {t}) as {m}") for m, t in types.items()]
    return rows.groupBy(*keys).agg(*largest, *sums, *counts)
