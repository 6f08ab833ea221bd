"""Running totals over groups of any size: no group has to fit into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import saved


def running(rows: DataFrame, group: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of a group that come earlier in the order.

    Rows are cut into ranges of (group, order), so a hot group lies in many of them; each range adds up its own rows, and the
    totals of a group's ranges, a row for each, give the offsets.  Rows that tie take any order among themselves.  Group
    columns must not be null; nulls in the order come first.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id()).withColumn("_value", value.cast("long"))
    ranged = tied.repartitionByRange(*group, *order, "_tie").withColumn("_part", F.spark_partition_id())
    ranged = saved(ranged, "ranged")
    inside = Window.partitionBy("_part", *group).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part", *group).agg(F.sum("_value").alias("_total"))
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    own = F.coalesce(F.sum("_value").over(inside), F.lit(0))
    joined = ranged.withColumn("_own", own).join(offsets, ["_part", *group])
    return joined.select(*rows.columns, (F.col("_offset") + F.col("_own")).cast("long").alias(out))
