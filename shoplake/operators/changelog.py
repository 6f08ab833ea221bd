"""Folding row changes into the current state of a keyed table.

A change row is the table's columns plus

* ``_op``   ``U`` the row's new state, ``B`` its state before an update, ``D`` deleted
* ``_seq``  position of the change in the source log: number of the log file, place in it, row of a change of many rows
* ``_ts``   source time of the change, in milliseconds; decides where the source gives no position

A keyed table keeps ``_op``, ``_ts`` and ``_seq`` too: a delete stays as a ``D``
row, so an older change that arrives later cannot bring the row back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.times import day_text

META = ("_op", "_ts", "_seq")
ORDER = ("_seq", "_ts")
# A position in a source's log.
POSITION = "struct<file:bigint,pos:bigint,row:bigint>"


def position(file: int | Column, pos: int | Column, row: int | Column = 0) -> Column:
    parts = {"file": file, "pos": pos, "row": row}
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("bigint").alias(k) for k, v in parts.items()])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ORDER) -> DataFrame:
    """The newest row of each key.

    The rank filter is pushed below the shuffle (each task sends at most one
    row per key), so a key with very many changes does not fill one task.
    """
    newest_first = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def apply_changes(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = ORDER,
    replace: bool = False,
) -> DataFrame:
    """Current rows after the changes; the newest change of each key wins.

    Deleted keys stay as ``D`` rows; read through :func:`live_rows`.  Applying
    the same changes again, or older ones later, gives the same result: of two rows
    with one position the current one stays.  With ``replace`` a change wins whatever its position.
    """
    states = changes.where(F.col("_op") != "B")
    if current is None:
        return latest_by_key(states, keys, order)
    merged = current.withColumn("_new", F.lit(0)).unionByName(states.withColumn("_new", F.lit(1)))
    newest = [F.col("_new"), *order] if replace else [*order, -F.col("_new")]
    return latest_by_key(merged, keys, newest).drop("_new")


def transitions(
    current: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """What the changes really do to the table: ``B`` the row a key had, ``U`` the row it gets.

    A source's own images do not tell: a change may be older than what is stored, come twice, or find another row than
    it expected.  Summing ``U`` rows and subtracting ``B`` rows follows the table exactly.
    """
    new = latest_by_key(changes.where(F.col("_op") != "B"), keys, order)
    if current is None:
        return new.where("_op = 'U'")
    old = current.select([F.col(k).alias(f"_{k}") for k in keys] + [F.struct(*new.columns).alias("_old")])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    met = new.select(*keys, F.struct(*new.columns).alias("_row")).join(old, same, "left")
    position = [F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("_row", "_old")]
    met = met.where(F.col("_old").isNull() | (position[0] > position[1]))
    had = F.when(F.col("_old._op") != "D", F.struct(F.lit("B").alias("_sign"), F.col("_old").alias("_of")))
    has = F.when(F.col("_row._op") != "D", F.struct(F.lit("U").alias("_sign"), F.col("_row").alias("_of")))
    rows = met.select(F.explode(F.array_compact(F.array(had, has))).alias("_i")).select("_i._of.*", "_i._sign")
    return rows.withColumn("_op", F.col("_sign")).drop("_sign")


def live_rows(df: DataFrame) -> DataFrame:
    """Rows that exist, without the change columns."""
    return df.where(F.col("_op") != "D").drop(*META)


def change_rows(envelopes: DataFrame, keys: Sequence[str], event_time: str | None = None) -> DataFrame:
    """Change records ``(op, ts_ms, seq, before, after)`` to change rows, in one pass; ``seq`` is a position.

    ``op`` is ``r`` (snapshot read), ``c``, ``u`` or ``d``.  With ``event_time``
    the rows get the day column ``dt``.  An update that moves a row to another
    key (its day was edited) deletes the old key; otherwise the state before it
    is kept as a ``B`` row, so an aggregate can tell which groups lost a value.
    """

    def key(image: str, name: str) -> Column:
        return day_text(F.col(f"{image}.{event_time}")) if name == "dt" else F.col(f"{image}.{name}")

    moved = F.lit(False)
    for name in keys:
        moved = moved | ~key("before", name).eqNullSafe(key("after", name))
    op = F.col("op")
    new = F.when(
        op.isin("r", "c", "u") & F.col("after").isNotNull(),
        F.struct(F.lit("U").alias("_op"), F.col("after").alias("_row")),
    )
    old = F.when(
        op.isin("u", "d") & F.col("before").isNotNull(),
        F.struct(F.when((op == "d") | moved, "D").otherwise("B").alias("_op"), F.col("before").alias("_row")),
    )
    images = F.explode(F.array_compact(F.array(old, new)))
    rows = envelopes.select(images.alias("_image"), F.col("ts_ms").alias("_ts"), F.col("seq").alias("_seq"))
    rows = rows.select("_image._row.*", "_image._op", "_ts", "_seq")
    return rows.withColumn("dt", day_text(F.col(event_time))) if event_time else rows


def affected_groups(changes: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts that belong to a group some change touched.

    A group is touched by its rows' new and old states, so groups that lost a
    row are found too.
    """
    touched = changes.select(*keys).dropna().distinct()
    return facts.join(touched, list(keys), "left_semi")
