"""Connected components of links that no machine needs to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import saved


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b), a the smaller, that reach what the given ones reach, about twice as many as nodes at most.

    A node keeps the link to the smallest of its smaller neighbours, and the others are linked to that one instead of to the
    node.  Each such round is one grouping without a join, in which a node's links are sorted, not held; it is repeated until
    there are few enough, however many were given.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    while True:
        links = saved(links.distinct(), "thinned")
        n = links.agg(F.count("*").alias("links"), F.approx_count_distinct("b").alias("ends")).first()
        if n.links <= 2 * n.ends:
            return links
        least = F.min("a").over(Window.partitionBy("b"))
        links = links.withColumn("least", least).select(
            F.col("least").alias("a"), F.when(F.col("a") == F.col("least"), F.col("b")).otherwise(F.col("a")).alias("b")
        )


def components(links: DataFrame) -> DataFrame:
    """node and comp, the smallest node that links (a, b) reach, for every node that has a link.

    Each round takes the least label of a node's neighbours and then the label of that label, so that chains shorten by half;
    rounds are written, so a lost executor repeats one round at most.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = saved(both.where("a <> b").distinct(), "links")
    labels = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        least = labels.join(near, "node").select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("before"))
        to = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = least.join(to, "comp").select("node", F.least("comp", "further").alias("comp"), "before")
        new = saved(new, "labels")
        labels = new.select("node", "comp")
        if new.where("comp <> before").isEmpty():
            return labels
