"""Turning stored rows back into the records a source would have sent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A compressed file is read by one task, so it is kept small.
_LINES = 20_000


def write_records(rows: DataFrame, path: str) -> None:
    """Add rows as JSON lines, compressed, as they repeat every column's name; a NULL field is left out."""
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    writer = lines.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", _LINES).text(path)


def write_changes(
    rows: DataFrame,
    path: str,
    op: str,
    seq: Column,
    before: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    file: str | None = None,
) -> None:
    """Add rows as change records.

    Creations carry the row as their new state and deletes as their old one.
    An update also needs ``before``, the old states with the same ``id``, or a function that makes them of the rows by changing
    columns, so that nothing is joined.  With ``file`` the records say where they stand in
    that log file, as capture tools do, instead of giving a plain number.
    """
    image = F.struct(*rows.columns)
    seq = seq.cast("bigint").alias("seq")
    if file:
        seq = F.struct(F.lit(file).alias("file"), seq.alias("pos"), F.lit(0).alias("row")).alias("source")
    place = "source" if file else "seq"
    if op == "u":
        if before is None:
            raise ValueError("an update needs the rows before it")
        if callable(before):
            states = before(rows.where("id is not null").select("*", image.alias("after"), seq))
            states = states.withColumn("before", F.struct(*[c for c in states.columns if c not in ("after", place)]))
        else:
            old = before.select(F.col("id").alias("_id"), F.struct(*before.columns).alias("before"))
            states = rows.select("id", image.alias("after"), seq).join(old, F.col("id") == F.col("_id"))
        records = states.select(F.lit(op).alias("op"), F.lit(0).alias("ts_ms"), place, "before", "after")
    else:
        name = "before" if op == "d" else "after"
        records = rows.select(F.lit(op).alias("op"), F.lit(0).alias("ts_ms"), seq, image.alias(name))
    write_records(records, path)
