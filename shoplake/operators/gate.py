"""A gate for bad rows: a batch may hold some, which are set aside; too many stop it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shoplake.operators import files

# Share of bad rows a batch may have.
LIMIT = 0.1


class TooManyBadRows(ValueError):
    """A batch was refused; its bad rows lie in the quarantine."""


def reasons(checks: Mapping[str, Column]) -> Column:
    """Names of the conditions that hold for a row, as an array; a condition that is NULL does not hold."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))


def gated(batch: DataFrame, bad: str, quarantine: str, batch_id: str | int, limit: float = LIMIT) -> DataFrame:
    """The good rows of a batch, without the column ``bad``, an array of reasons.

    The others are written to ``quarantine`` in a directory of the batch, which a repeated run replaces; the same pass counts all
    rows.  If more than ``limit`` of them are bad, the batch fails before anything else is written.  Keep the batch persisted, as
    it is read twice.
    """
    wrong = F.size(bad) > 0
    counts = Observation()
    seen = batch.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("bad"))
    aside = f"{quarantine}/batch={batch_id}"
    seen.where(wrong).write.mode("overwrite").option("compression", "zstd").orc(aside)
    rows, wrongs = counts.get["rows"], counts.get["bad"]
    if not wrongs:
        files.remove(batch.sparkSession, aside)
    if wrongs > limit * rows:
        raise TooManyBadRows(f"{wrongs} of {rows} rows of batch {batch_id} are bad; they lie in {quarantine}")
    return batch.where(~wrong).drop(bad)
