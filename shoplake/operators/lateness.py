"""Watermarks: how far event time has come in a stream, and which rows are later than allowed.

The mark of a batch is the latest event time of the batches before it, less the delay, as a streaming engine has it.  It is kept
beside the table, a row for each batch, so a restarted stream goes on with it and a repeated batch gets the same one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shoplake.operators import files


@dataclass(frozen=True)
class Watermark:
    """``delay`` as an interval (``5 seconds``); late rows are kept, which is the default, or dropped from the table."""

    delay: str = "5 seconds"
    drop: bool = False


@dataclass(frozen=True)
class Late:
    """What a batch is judged by: the mark before it, None at first."""

    mark: str | None
    path: str
    batch_id: str


def before(spark, path: str, batch_id: str) -> Late:
    """The mark that the batches before this one set."""
    stream, _, number = batch_id.rpartition(".")
    marks = []
    for name in files.subdirectories(spark, path):
        of, _, n = name.removeprefix("batch=").rpartition(".")
        if of == stream and int(n) < int(number):
            marks.append((int(n), name))
    if not marks:
        return Late(None, path, batch_id)
    line = json.loads(files.text(spark, f"{path}/{max(marks)[1]}/_mark"))
    return Late(line["next"], path, batch_id)


def judged(batch: DataFrame, time: str, late: Late) -> DataFrame:
    """Adds ``_late``: whether the row's event time lies before the mark; a row without a time is not late."""
    mark = F.lit(late.mark).cast("timestamp_ntz")
    return batch.withColumn("_late", F.coalesce(F.col(time) < mark, F.lit(False)))


def side_output(batch: DataFrame, time: str, late: Late, watermark: Watermark) -> None:
    """Write a batch's late rows beside the table, with counts of all and of late rows and the mark for the next batch.

    One pass.  The mark never goes back.
    """
    spark, counts = batch.sparkSession, Observation()
    span = F.expr(f"interval {watermark.delay}")
    seen = batch.observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"), F.max(F.col(time) - span).cast("string").alias("next")
    )
    target = f"{late.path}/batch={late.batch_id}"
    seen.where("_late").drop("_late").write.mode("overwrite").option("compression", "zstd").orc(target)
    got = counts.get
    marks = [m for m in (late.mark, got["next"]) if m is not None]
    line = {"mark": late.mark, "rows": got["rows"], "late": got["late"], "next": max(marks, default=None)}
    files.write_text(spark, f"{target}/_mark", json.dumps(line))


def counts(spark, path: str) -> DataFrame:
    """mark, rows and late of every batch."""
    names = files.subdirectories(spark, path)
    lines = [json.loads(files.text(spark, f"{path}/{n}/_mark")) for n in names if files.exists(spark, f"{path}/{n}/_mark")]
    rows = [(line["mark"], line["rows"], line["late"]) for line in lines]
    return spark.createDataFrame(rows, "mark string, rows bigint, late bigint")
