"""Lookup joins, tree flattening and id-list explosion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.operators import sizing

_NULL_SPREAD = 1024


def _identity(columns: list[str]) -> list[str]:
    """Few columns that tell rows apart; using all would keep them from being pruned."""
    for known in (["id"], ["mid", "create_time"]):
        if set(known) <= set(columns):
            return known
    return columns


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str | Column, str],
    cols: Mapping[str, str],
    cond: Column | None = None,
    broadcast_bytes: int = sizing.BROADCAST_BYTES,
    identity: Sequence[str] | None = None,
) -> DataFrame:
    """Left join that takes a dimension's values as they are now.

    ``on`` is (fact key, dimension key); the dimension key must be unique.
    ``cols`` maps output names to dimension columns.  ``cond`` is an extra
    condition on fact columns: rows that fail it keep NULLs.  Fact rows are
    never dropped.  ``identity`` names columns that tell rows without a key
    apart; without it they are guessed.

    A dimension that is small, by its files and by its rows if they are counted, is broadcast, so the fact is not
    shuffled.  A larger one is shuffled with the fact; rows that cannot match
    (NULL key, failed ``cond``) are spread evenly instead of meeting in one
    partition, and adaptive execution splits partitions of hot keys.
    """
    key, dim_key = on
    key = F.col(key) if isinstance(key, str) else key
    typ = dim.schema[dim_key].dataType.simpleString()
    key = key.cast(typ)
    key = key if cond is None else F.when(cond, key)
    columns = fact.columns
    fact = fact.withColumn("_key", key)
    side = [f"`{dim_key}` as _dim_key", *[f"`{c}` as `_dim_{out}`" for out, c in cols.items()]]
    if sizing.fits_in_memory(dim, [dim_key, *cols.values()], broadcast_bytes):
        joined = fact.join(F.broadcast(dim.selectExpr(*side)), F.col("_key") == F.col("_dim_key"), "left")
    else:
        # A row that cannot match hashes on what tells it from others, so NULL keys no longer share one partition.
        identity = ", ".join(f"`{c}`" for c in identity or _identity(columns))
        salt = f"if(_key is null, pmod(xxhash64({identity}), {_NULL_SPREAD}L) + 1, 0L) as _salt"
        fact = fact.selectExpr(*[f"`{c}`" for c in columns], salt, f"coalesce(_key, cast(0 as {typ})) as _key")
        # Always 0, but not a literal: a literal would be folded out of the join keys.
        zero = f"pmod(xxhash64(`{dim_key}`), 1L) as _dim_salt"
        match = (F.col("_key") == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt"))
        # Compressed files say little about rows, so left to itself Spark would broadcast a large dimension of small files.
        joined = fact.join(dim.selectExpr(*side, zero).hint("merge"), match, "left")
    return joined.selectExpr(*[f"`{c}`" for c in columns], *[f"`_dim_{out}` as `{out}`" for out in cols])


def flatten_tree(
    df: DataFrame, id: str = "id", parent: str = "parent_id", name: str = "category_name", levels: int = 3,
    prefix: str = "category", nodes: DataFrame | None = None,
) -> DataFrame:
    """Put every ancestor of a node beside it.

    The node itself fills level ``levels``; its parent the level above, and so
    on.  A missing ancestor gives NULLs.  ``nodes`` is the whole tree where ``df`` is only some of it.
    """
    nodes = (df if nodes is None else nodes).select(F.col(id).alias("_id"), F.col(parent).alias("_up"), F.col(name).alias("_name"))
    out = df.withColumn(f"{prefix}{levels}_id", F.col(id)).withColumn(f"{prefix}{levels}_name", F.col(name))
    out = out.withColumn("_next", F.col(parent))
    for level in range(levels - 1, 0, -1):
        cols = {f"{prefix}{level}_id": "_id", f"{prefix}{level}_name": "_name", "_above": "_up"}
        out = lookup_join(out, nodes, ("_next", "_id"), cols)
        out = out.drop("_next").withColumnRenamed("_above", "_next")
    return out.drop("_next")


def explode_ids(df: DataFrame, col: str, sep: str = ",", as_: str = "sku_id") -> DataFrame:
    """One row per id of a separated list; NULL lists give no row, non-numeric ids give NULL."""
    pattern = "\\Q" + sep + "\\E"
    item = F.explode(F.split(F.col(col), pattern))
    return df.withColumn("_item", item).withColumn(as_, F.col("_item").try_cast("bigint")).drop("_item")
