"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, with cycle walking.

Rows get gapless numbers in the order of (id, crc32 and size of the text); rows that tie are equal in the result.  The
permutation of 0 .. n-1 depends on n and the key alone, so anyone can compute where row number r lies: shard = p(r) mod shards,
slot = p(r) div shards.  Shards therefore differ by one row at most and their slots have no gaps.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import saved

ROUNDS = 6
# Steps of a cycle that one pass walks; most rows need one or two, what is left walks on in another pass.
WALK = 64


def feistel(value: Column, bits: int, key: int, rounds: int = ROUNDS) -> Column:
    """A permutation of 0 .. 2**bits - 1: halves of bits // 2 and the rest, which change places in every round."""
    low = bits // 2
    widths = (bits - low, low)

    def turn(v: Column, i: Column) -> Column:
        even = i % 2 == 0
        right, left = F.when(even, F.lit(widths[0])).otherwise(widths[1]), F.when(even, F.lit(widths[1])).otherwise(widths[0])
        shift = lambda x, n: F.call_function("shiftleft", x, n)
        r = v.bitwiseAND(shift(F.lit(1).cast("long"), right) - 1)
        l_ = F.call_function("shiftright", v, right)
        mixed = F.xxhash64(r, F.lit(key), i).bitwiseAND(shift(F.lit(1).cast("long"), left) - 1)
        return shift(r, left).bitwiseOR(l_.bitwiseXOR(mixed))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds + rounds % 2 - 1)), value, turn)


def walk(value: Column, n: int, bits: int, key: int, steps: int = WALK) -> Column:
    """The permutation again and again while the value lies beyond n, at most `steps` times."""
    step = lambda v, _: F.when(v >= n, feistel(v, bits, key)).otherwise(v)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), value, step)


def permuted(rows: DataFrame, number: str, n: int, key: int, steps: int = WALK) -> DataFrame:
    """Adds `place`: where the permutation of 0 .. n-1 puts the row of that number."""
    bits = max(2, (n - 1).bit_length())
    out = rows.withColumn("place", walk(feistel(F.col(number), bits, key), n, bits, key, steps))
    while True:
        out = saved(out, "places")
        if out.where(F.col("place") >= n).isEmpty():
            return out
        out = out.withColumn("place", walk(F.col("place"), n, bits, key, steps))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Adds `number`, gapless from 0 in that order over the whole table, and tells how many rows there are.

    One range shuffle, which also cuts rows that tie; the offsets of the ranges are a row for each task of it, looked up by a
    join.  Nulls come first.
    """
    spark = rows.sparkSession
    tied = [*order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*tied).sortWithinPartitions(*tied)
    in_part = saved(ranged.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"), "numbered")
    counts = sorted(tuple(r) for r in in_part.groupBy(F.shiftright("_at", 33)).count().collect())
    starts, n = [], 0
    for part, count in counts:
        starts.append((part, n))
        n += count
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    found = in_part.join(offsets, F.shiftright("_at", 33) == F.col("_part"))
    return found.select(*rows.columns, (F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("number")), n


def sharded(
    docs: DataFrame, shards: int = 8, key: int = 20260701, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size (UTF-8 bytes and one), text_crc32, shard and slot of every row.

    A null text counts no bytes.  Rows that repeat are numbered one after the other, so each gets a slot of its own.
    No rows give no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    lines, n = numbered(rows, order)
    return permuted(lines, "number", n, key).select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
