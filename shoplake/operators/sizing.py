"""How much data a plan reads, known before it runs."""

from __future__ import annotations

from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame

# A plan's files do not change, and a dimension is looked up many times.
_known: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_rows: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()

MB = 1 << 20

# Bytes that a row held in memory takes beside its columns, and that a text and any other column take.
_ROW, _TEXT, _NUMBER = 32, 40, 16

# A dimension is broadcast only while all files behind it are smaller than this.
BROADCAST_BYTES = 32 * MB
# A window over a whole day stays a plain window only while all files behind it are smaller than this.
SINGLE_GROUP_BYTES = 256 * MB


def input_bytes(df: DataFrame) -> int | None:
    """Total size of the files the plan reads; None when that is unknown.

    Joins on unique keys, filters and aggregates never make a dimension larger
    than its inputs, so this bounds it.  Data without file statistics (rows made
    on the driver, streaming batches) reports a huge size and counts as large.
    """
    jdf = getattr(df, "_jdf", None)
    if jdf is None:  # no JVM handle, as in a remote session
        return None
    if df not in _known:
        leaves = jdf.queryExecution().analyzed().collectLeaves()
        _known[df] = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return _known[df]


def fits(df: DataFrame, limit: int) -> bool:
    size = input_bytes(df)
    return size is not None and size <= limit


def note_rows(df: DataFrame, rows: int) -> DataFrame:
    """The same DataFrame, known to have so many rows."""
    _rows[df] = rows
    return df


def fits_in_memory(df: DataFrame, columns: Sequence[str], limit: int) -> bool:
    """Whether the columns of a dimension may be held whole by the driver and every task.

    Compressed files say little about that, so where the number of rows is known it decides too.
    """
    if df not in _rows:
        return fits(df, limit)
    types = dict(df.dtypes)
    width = _ROW + sum(_TEXT if types[c] == "string" else _NUMBER for c in columns)
    return fits(df, limit) and _rows[df] * width <= limit
