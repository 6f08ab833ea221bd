"""Aggregates kept up to date by signed deltas, without reading a fact again.

The state of an aggregate is two keyed tables:

* cells: per group and combination of attributes the rows that carry it (``n``) and the sums of their measures.  A group's
  attribute is the largest of its cells that still have rows, so it can go back when rows go;
* values: per group and value of a distinct count the rows that have it.  A value that gets its first row adds one to the
  count, one that loses its last row takes one away; these steps go into the cells like any other delta.

Every state row remembers the batch that changed it last, so a repeated batch is added once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.operators.gate import reasons
from shoplake.operators.measures import Stats, aligned


def signed(rows: DataFrame, stats: Stats, fact: str, sign: Column) -> DataFrame:
    """Changes of a fact table in the aggregate's shape, with ``_sign`` 1 for a row that came and -1 for one that went."""
    others = list(dict.fromkeys(stats.distinct.values()))
    shaped = aligned(
        rows.withColumn("_sign", sign), stats.sources[fact], stats.keys, stats.attrs, stats.types, [*others, "_sign"]
    )
    return shaped.withColumn("dt", F.col("dt").cast("string"))


def _wide(typ: str) -> str:
    """Sums in the state have room for more than the result's type."""
    return "decimal(38,4)" if typ.startswith("decimal") else typ


def _counters(stats: Stats) -> dict[str, str]:
    return {"n": "bigint", **{m: _wide(t) for m, t in stats.types.items()}, **dict.fromkeys(stats.distinct, "bigint")}


def cell_deltas(rows: DataFrame, stats: Stats) -> DataFrame:
    """Signed rows as cells of one row each; they are summed once, with the state."""
    sums = [F.when(F.col("_sign") < 0, -F.col(m)).otherwise(F.col(m)).cast(_wide(t)).alias(m) for m, t in stats.types.items()]
    steps = [F.lit(0).cast("bigint").alias(c) for c in stats.distinct]
    return rows.select(*stats.keys, *stats.attrs, F.col("_sign").cast("bigint").alias("n"), *sums, *steps)


def value_deltas(rows: DataFrame, stats: Stats) -> DataFrame:
    """Signed rows per group, distinct count and value."""
    each = [
        rows.where(F.col(c).isNotNull()).select(
            *stats.keys, F.lit(name).alias("of"), F.col(c).cast("string").alias("value"), F.col("_sign").cast("bigint").alias("n")
        )
        for name, c in stats.distinct.items()
    ]
    return reduce(DataFrame.unionAll, each)


def folded(
    current: DataFrame | None, deltas: DataFrame, keys: Sequence[str], counters: Sequence[str], batch: int, repeated: bool = True
) -> DataFrame:
    """State rows after a batch: its deltas are added, but not to rows that have them already.

    ``_before`` is what the first counter was before the row's last batch.  Rows that came down to zero are dropped by the
    next batch that touches their partition.  With ``repeated`` False no stored row has the batch, so stored rows and
    deltas need not be summed apart.
    """
    zero = F.lit(0).cast("bigint")
    new = deltas.select(*keys, *counters, zero.alias("_before"), F.lit(None).cast("bigint").alias("_batch"), F.lit(True).alias("_new"))
    rows = new if current is None else current.select(*keys, *counters, "_before", "_batch", F.lit(False).alias("_new")).unionAll(new)
    is_new, first, types = F.col("_new"), counters[0], dict(rows.dtypes)

    def summed(col: Column, c: str) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast(types[c])

    had = summed(F.when(~is_new, F.col(first)), first).alias(f"_had_{first}")
    marks = [F.max("_before").alias("_was"), F.max("_batch").alias("_last"), F.bool_or("_new").alias("_touched")]
    if current is None or not repeated:
        sums = rows.groupBy(*keys).agg(*[summed(F.col(c), c).alias(c) for c in counters], had, *marks)
        again = F.lit(False)
    else:
        others = [summed(F.when(~is_new, F.col(c)), c).alias(f"_had_{c}") for c in counters if c != first]
        came = [summed(F.when(is_new, F.col(c)), c).alias(f"_came_{c}") for c in counters]
        sums = rows.groupBy(*keys).agg(had, *others, *came, *marks)
        again = F.coalesce(F.col("_last") == batch, F.lit(False))
        after = [F.when(again, F.col(f"_had_{c}")).otherwise(F.col(f"_had_{c}") + F.col(f"_came_{c}")) for c in counters]
        sums = sums.select("*", *[v.cast(types[c]).alias(c) for c, v in zip(counters, after)])
    out = sums.select(
        *keys,
        *counters,
        F.when(again | ~F.col("_touched"), F.col("_was")).otherwise(F.col(f"_had_{first}")).cast("bigint").alias("_before"),
        F.when(F.col("_touched"), F.lit(batch)).otherwise(F.col("_last")).cast("bigint").alias("_batch"),
    )
    kept = F.col("_batch") == batch
    for c in counters:
        kept = kept | (F.col(c) != 0)
    return out.where(kept)


def steps(values: DataFrame, stats: Stats, batch: int) -> DataFrame:
    """What the batch did to the distinct counts, as cell deltas without attributes and rows."""
    moved = (F.col("n") > 0).cast("bigint") - (F.col("_before") > 0).cast("bigint")
    rows = values.where(F.col("_batch") == batch).withColumn("_step", moved).where("_step != 0")
    counts = [F.coalesce(F.sum(F.when(F.col("of") == c, F.col("_step"))), F.lit(0)).cast("bigint").alias(c) for c in stats.distinct]
    sums = rows.groupBy(*stats.keys).agg(*counts)
    return sums


def as_cells(step_rows: DataFrame, cells: DataFrame, stats: Stats) -> DataFrame:
    """Steps in the shape of the cells."""
    types = dict(cells.dtypes)
    nulls = [F.lit(None).cast(types[a]).alias(a) for a in stats.attrs]
    zeros = [F.lit(0).cast(types[m]).alias(m) for m in ("n", *stats.types)]
    return step_rows.select(*stats.keys, *nulls, *zeros, *stats.distinct)


def groups(cells: DataFrame, stats: Stats, batch: int) -> DataFrame:
    """The aggregate's rows of the groups that a batch touched, from all cells of these, with ``_op`` ``D`` for groups that have
    no rows left.

    A sum that does not fit its type is NULL and named in ``_bad``.
    """
    alive = F.col("n") > 0
    attrs = [F.max(F.when(alive, F.col(a))).alias(a) for a in stats.attrs]
    touched = F.bool_or(F.col("_batch") == batch).alias("_touched")
    rows = cells.groupBy(*stats.keys).agg(*attrs, *[F.sum(c).alias(c) for c in _counters(stats)], touched).where("_touched")
    typed = {m: F.col(m).try_cast(t) for m, t in stats.types.items()}
    bad = reasons({f"{m} too large": F.col(m).isNotNull() & v.isNull() for m, v in typed.items()})
    op = F.when(F.col("n") > 0, "U").otherwise("D").alias("_op")
    sums = [v.alias(m) for m, v in typed.items()]
    return rows.select(*stats.keys, *stats.attrs, *sums, *stats.distinct, op, bad.alias("_bad"))
