"""Analysis models: funnel, retention and customer value segments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.ratios import ratio


def funnel(stages: Sequence[tuple[str, DataFrame]], user: str = "user_id", day: str = "dt") -> DataFrame:
    """Distinct users per day and stage.

    A stage counts the users seen in it that day, in any order of time.  The
    first stage counts every user seen in any stage.  Rows are reduced to one
    per user and day first, so no distinct count is needed afterwards.
    """
    names = [name for name, _ in stages]

    def flagged(name: str, df: DataFrame) -> DataFrame:
        flags = [F.lit(int(n == name)).alias(n) for n in names]
        return df.where(F.col(user).isNotNull()).select(user, F.col(day).cast("date").alias(day), *flags)

    rows = reduce(DataFrame.unionByName, [flagged(n, df) for n, df in stages])
    per_user = rows.groupBy(user, day).agg(*[F.max(n).alias(n) for n in names])
    counts = [F.count(F.lit(1)).alias(f"{names[0]}_users")]
    counts += [F.sum(n).alias(f"{n}_users") for n in names[1:]]
    return per_user.groupBy(day).agg(*counts)


def retention(
    activity: DataFrame,
    new: str,
    count: str,
    rate: str,
    days: Sequence[int] = (1, 7, 30),
    user: str = "user_id",
    day: str = "dt",
) -> DataFrame:
    """Users of each first day that come back exactly ``days`` later.

    ``activity`` has one row per user and day.  ``count`` and ``rate`` are name
    patterns such as ``day{}_retained``.  A user's first day comes from a window over
    that user's days, which are few, so no self-join is needed; day 0 is the
    cohort itself.
    """
    first = F.min(day).over(Window.partitionBy(user))
    gaps = activity.select(first.alias("_first"), F.datediff(day, first).alias("_gap"))
    gaps = gaps.where(F.col("_gap").isin(0, *days))

    def users(gap: int) -> Column:
        return F.count(F.when(F.col("_gap") == gap, 1))

    cohorts = gaps.groupBy(F.col("_first").alias(day)).agg(
        users(0).alias(new), *[users(d).alias(count.format(d)) for d in days]
    )
    rates = [ratio(F.col(count.format(d)) * 100, F.col(new), 2).alias(rate.format(d)) for d in days]
    return cohorts.select("*", *rates)


# Segment names by (recent, frequent, large) against the mean.
SEGMENTS = {
    (1, 1, 1): "高价值用户",
    (0, 1, 1): "重点保持用户",
    (1, 0, 1): "重点发展用户",
    (0, 0, 1): "重点挽留用户",
    (1, 1, 0): "一般价值用户",
    (0, 1, 0): "一般保持用户",
    (1, 0, 0): "一般发展用户",
    (0, 0, 0): "流失预警用户",
}


def rfm(df: DataFrame, as_of: date | Column, user: str = "user_id", day: str = "dt") -> DataFrame:
    """Recency, frequency and money per user against the mean of all users.

    ``df`` has one row per user and day with ``order_count`` and
    ``order_total_amount``.  The means are one row, read as a scalar subquery.
    """
    at = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    raw = (
        df.where("order_count > 0")
        .groupBy(user)
        .agg(
            F.max("user_nick_name").alias("user_nick_name"),
            F.max("user_level").alias("user_level"),
            F.datediff(at, F.max(day)).alias("recency"),
            F.sum("order_count").cast("bigint").alias("frequency"),
            F.sum("order_total_amount").cast("decimal(18,2)").alias("monetary"),
        )
    )
    axes = ("recency", "frequency", "monetary")
    # Counting the other columns keeps both uses of ``raw`` alike, so its shuffle is done once and used twice.
    alike = [F.count(c).alias(c) for c in ("user_nick_name", "user_level")]
    means = raw.agg(F.struct(*[ratio(F.sum(a), F.count(a)).alias(a) for a in axes], *alike).alias("means")).scalar()
    scored = raw.withColumn("_mean", means)
    better = {
        "r_score": F.col("recency").cast("double") <= F.col("_mean.recency"),
        "f_score": F.col("frequency").cast("double") >= F.col("_mean.frequency"),
        "m_score": F.col("monetary").cast("double") >= F.col("_mean.monetary"),
    }
    for name, test in better.items():
        scored = scored.withColumn(name, F.when(test, 1).otherwise(0))
    labels = F.array(*[F.lit(SEGMENTS[r, f, m]) for r in (0, 1) for f in (0, 1) for m in (0, 1)])
    label = F.element_at(labels, F.col("r_score") * 4 + F.col("f_score") * 2 + F.col("m_score") + 1)
    known = F.col("recency").isNotNull() & F.col("frequency").isNotNull() & F.col("monetary").isNotNull()
    return scored.drop("_mean").withColumn("user_segment", F.when(known, label).otherwise(SEGMENTS[0, 0, 0]))
