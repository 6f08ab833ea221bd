"""Ranks within a day: full rankings and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

from shoplake.operators import sizing

# Cuts of the sort order: steps of a number's size for each doubling of it, and whole numbers with a step of their own.
_STEPS = 16
_WHOLE = 64
_NUMBERS = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def _order(measure: str | Column, ties: Sequence[str]) -> list[Column]:
    measure = F.col(measure) if isinstance(measure, str) else measure
    return [measure.desc(), *[F.col(t).asc() for t in ties]]


def top_by(
    df: DataFrame, partition: Sequence[str], measure: str | Column, ties: Sequence[str], k: int, name: str = "rn"
) -> DataFrame:
    """The ``k`` first rows of each partition, largest measure first.

    The rank filter runs before the shuffle too: a task sends at most ``k``
    rows per partition value, however many rows a day holds.
    """
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*_order(measure, ties)))
    return df.withColumn(name, rank).where(F.col(name) <= k)


def rank_by(
    df: DataFrame,
    partition: Sequence[str],
    ranks: dict[str, str | Column],
    ties: Sequence[str],
    single_group_bytes: int = sizing.SINGLE_GROUP_BYTES,
) -> DataFrame:
    """Number all rows of each partition, once per entry of ``ranks``.

    ``ranks`` maps a new column to the measure it ranks by, largest first;
    ``ties`` (unique within the partition) break ties in ascending order.

    Small inputs use a plain window.  A day of a large table would be sorted by
    one task there, so larger inputs are cut into ranges of the sort order that
    many tasks number in parallel (see :func:`_number_in_ranges`).
    """
    if sizing.fits(df, single_group_bytes):
        for name, measure in ranks.items():
            df = df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*_order(measure, ties))))
        return df
    columns = df.columns
    for name, measure in ranks.items():
        df = _number_in_ranges(df, partition, measure, ties, name)
    return df.select(*columns, *ranks)


def _step(value: Column) -> Column:
    """A whole number that never falls while the value rises: steps grow with the value, so there are few of them."""
    steps = F.floor(F.least(F.log2(F.abs(value) + 1), F.lit(2000.0)) * _STEPS)
    return F.when(value < 0, -steps).otherwise(steps)


def _range_of(measure: Column, tie: Column, tie_type: DataType) -> Column:
    """The range that a row's place in the sort order falls into; ranges ascend as places do.

    NULL measures come last.  Rows of equal measure are cut too, by the first tie column if that is a number, where the
    measure is NULL or a whole number of at most `_WHOLE`; only there is a range known to hold nothing else.
    """
    value = -measure
    size = value.cast("double")
    whole = F.greatest(F.least(F.rint(size), F.lit(float(_WHOLE))), F.lit(float(-_WHOLE))).cast("bigint")
    side = F.when(value < whole, -1).when(value > whole, 1).otherwise(0)
    key = F.lit(0).cast("bigint")
    if isinstance(tie_type, _NUMBERS):
        step = F.when(tie.isNull(), F.lit(-(1 << 20))).otherwise(_step(tie.cast("double")))
        key = F.when(side == 0, step).otherwise(key)
    return F.struct(measure.isNull().alias("n"), _step(size).alias("s"), whole.alias("w"), side.alias("e"), key.alias("k"))


def _number_in_ranges(df: DataFrame, partition: Sequence[str], measure: str | Column, ties: Sequence[str], name: str) -> DataFrame:
    """Exact row numbers without bringing a partition into one task.

    The sort order is cut into ranges by a fixed rule (:func:`_range_of`).  Rows are dealt to tasks by range and numbered there;
    the rows of a range are counted, and the running count of those before it is its offset.  Counts and numbers come from
    one and the same shuffle: both read all columns, so that Spark finds it twice and does it, and all that is below it, once.
    """
    m = F.col(measure) if isinstance(measure, str) else measure
    cut = df.withColumn("_range", _range_of(m, F.col(ties[0]), df.schema[ties[0]].dataType)).repartition(*partition, "_range")
    # The hash is never NULL: its test only keeps the columns from being left out.
    counted = cut.groupBy(*partition, "_range").agg(F.count(F.lit(1)).alias("_count"), F.max(F.xxhash64(*df.columns)).alias("_all"))
    before = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = [F.col(c).alias(f"_p{i}") for i, c in enumerate(partition)]
    offsets = counted.where("_all is not null").select(
        *parts, F.col("_range").alias("_of"), F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset")
    )
    match = F.col("_range") == F.col("_of")
    for i, c in enumerate(partition):
        match = match & F.col(c).eqNullSafe(F.col(f"_p{i}"))
    placed = cut.join(F.broadcast(offsets), match)
    number = F.row_number().over(Window.partitionBy(*partition, "_range").orderBy(*_order(m, ties))) + F.col("_offset")
    return placed.withColumn(name, number).select(*df.columns, name)
