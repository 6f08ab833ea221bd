"""Writing tables: whole snapshots, append-only logs and keyed upserts.

All tables are ORC with zstd.  Every write survives a lost executor (Spark
retries the task) and a restarted driver (running the same micro-batch again
gives the same table).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.operators import files, sizing
from shoplake.operators.changelog import ORDER, apply_changes, transitions

_STAGING = "_staging"
_VERSIONS_KEPT = 2
_SMALL_ROWS, _SMALL_BYTES = 1_000_000, 256 * sizing.MB
BUCKETS = 4


def _write(df: DataFrame, path: str, partition: Sequence[str] = (), mode: str = "overwrite", **options: str) -> None:
    writer = df.write.mode(mode).option("compression", "zstd").options(**options)
    (writer.partitionBy(*partition) if partition else writer).orc(path)


def _sized(df: DataFrame, *columns: str, small: bool = False) -> DataFrame:
    """Group rows by partition directory.

    Adaptive execution gives a large directory to several tasks and many small
    ones to one.  A batch known to be small is spread over the cores instead:
    it waits for creating files, not for data.
    """
    cols = [F.col(c) for c in columns]
    if small:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *cols)
    return df.hint("rebalance", *cols)


# --- snapshots -----------------------------------------------------------------


def current_version(spark: SparkSession, path: str) -> str | None:
    """Directory of the newest complete snapshot."""
    for name in reversed(files.subdirectories(spark, path)):
        if name.startswith("v") and files.complete(spark, f"{path}/{name}"):
            return f"{path}/{name}"
    return None


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Replace a whole table.

    A new version is written beside the old one and counts once it is
    complete, so readers never see half a table and ``df`` may read the old one.
    """
    spark = df.sparkSession
    names = [n for n in files.subdirectories(spark, path) if n.startswith("v")]
    number = int(names[-1][1:]) + 1 if names else 0
    _write(df, f"{path}/v{number:09d}")
    for old in [n for n in names if int(n[1:]) <= number - _VERSIONS_KEPT]:
        files.remove(spark, f"{path}/{old}")


def overwrite_days(df: DataFrame, path: str, whole: bool) -> None:
    """Replace the whole of a table partitioned by day, or only the days ``df`` has."""
    _write(_sized(df, "dt"), path, ["dt"], partitionOverwriteMode="static" if whole else "dynamic")


# --- append-only ---------------------------------------------------------------


NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def append_log(
    df: DataFrame,
    path: str,
    batch_id: str | int,
    cluster: str = "mid",
    writer: str | None = None,
    event_key: Sequence[str] | None = None,
) -> None:
    """Append a micro-batch, partitioned by day.

    The batch has its own directory in each day, moved in whole; a repeated batch writes only the days its first attempt did
    not come to, so neither the table nor a follower sees a row twice.  ``writer`` names the stream: rows
    of a log have no key, so a second stream, such as one whose checkpoint was lost,
    would add them again; it is refused.  With ``event_key``, columns that tell events apart, a second stream is welcome: events
    that another stream has stored are left out.  ``dt`` also stays in the
    files: a stream that starts before the first file cannot know the
    directories' columns.
    """
    spark = df.sparkSession
    df = df.withColumn("day", F.col("dt")).withColumn("batch", F.lit(str(batch_id)))
    if writer:
        others = [n for n in files.subdirectories(spark, f"{path}/_writers") if n != writer]
        if others and not event_key:
            raise ValueError(f"{path} holds the rows of another stream ({others[0]}): restore its checkpoint or use a new table")
        files.make(spark, f"{path}/_writers/{writer}")
        if others:
            df = _unknown(df, path, writer, event_key)
    begun = f"{path}/_begun/{batch_id}"
    if files.exists(spark, begun):
        days = [n for n in files.subdirectories(spark, path) if n.startswith("day=")]
        done = [n[4:] for n in days if files.exists(spark, f"{path}/{n}/batch={batch_id}")]
        df = df.where(~F.coalesce("day", F.lit(NO_DAY)).isin(done))
    else:
        for old in files.subdirectories(spark, f"{path}/_begun"):
            if old.rpartition(".")[0] == str(batch_id).rpartition(".")[0]:
                files.remove(spark, f"{path}/_begun/{old}")
        files.make(spark, begun)
    df = _sized(df, "day").sortWithinPartitions("day", cluster)
    _write(df, path, ["day", "batch"], partitionOverwriteMode="dynamic")


def _unknown(df: DataFrame, path: str, writer: str, event_key: Sequence[str]) -> DataFrame:
    """Rows whose event no other stream has stored; only the days of the batch are read."""
    spark = df.sparkSession
    if not [n for n in files.subdirectories(spark, path) if n.startswith("day=")]:
        return df
    days = [r[0] for r in df.select("day").distinct().collect()]  # days of one batch
    hit = F.col("day").isin([d for d in days if d is not None])
    hit = hit | F.col("day").isNull() if None in days else hit
    stored = spark.read.schema(df.schema).orc(path).where(hit & ~F.col("batch").startswith(f"{writer}."))
    same = F.col("_day").eqNullSafe(F.col("day"))
    for k in event_key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    seen = stored.select(F.col("day").alias("_day"), *[F.col(k).alias(f"_{k}") for k in event_key])
    return df.join(seen, same, "left_anti")


# --- keyed ---------------------------------------------------------------------


def with_bucket(df: DataFrame, key: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    columns = [key] if isinstance(key, str) else key
    return df.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))


def _parts_of(rows: DataFrame, partition: Sequence[str]) -> dict[tuple, int]:
    """Partition values of a batch and their rows: at most its days times the buckets."""
    return {tuple(r)[:-1]: r["n"] for r in rows.groupBy(*partition).agg(F.count(F.lit(1)).alias("n")).collect()}


def _in_parts(parts: Iterable[tuple], partition: Sequence[str]) -> Column:
    """Filter on partition columns; it prunes directories before any file is read."""
    buckets: dict[str | None, list[int]] = {}
    for part in parts:
        buckets.setdefault(part[0] if len(part) > 1 else None, []).append(part[-1])
    hit = F.lit(False)
    for day, numbers in buckets.items():
        here = F.col("bucket").isin(numbers)
        hit = hit | (here if len(partition) == 1 else here & F.col("dt").eqNullSafe(F.lit(day)))
    return hit


def _publish(spark: SparkSession, path: str, depth: int) -> None:
    """Move finished partitions from staging into the table.

    Safe to repeat: a partition is in staging or in place, never nowhere.  Unfinished
    staging is thrown away.
    """
    for batch in files.subdirectories(spark, f"{path}/{_STAGING}"):
        staged = f"{path}/{_STAGING}/{batch}"
        if files.complete(spark, staged):
            parts = [""]
            for _ in range(depth):
                parts = [f"{p}/{d}" for p in parts for d in files.subdirectories(spark, staged + p)]
            # Renames only wait for the file system, so several run at a time.
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda part: files.move(spark, staged + part, path + part), parts))
        files.remove(spark, staged)


def _current(spark: SparkSession, path: str, schema: StructType, parts: Iterable[tuple], parts_by: Sequence[str]) -> DataFrame | None:
    """Stored rows of some partitions; None if nothing is stored yet."""
    if not [d for d in files.subdirectories(spark, path) if not d.startswith("_")]:
        return None
    # With the schema given, day directories stay text and nothing is inferred.
    return spark.read.schema(schema).orc(path).where(_in_parts(parts, parts_by))


def fold_partitioned(
    rows: DataFrame,
    path: str,
    parts_by: Sequence[str],
    batch_id: str | int,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    schema: StructType,
) -> list[tuple]:
    """Merge a batch into the partitions it touches, and no others; returns them.

    ``merge`` makes their new rows of the stored ones and the batch.  They are staged completely before they
    replace the old ones.
    """
    spark = rows.sparkSession
    _publish(spark, path, len(parts_by))
    parts = _parts_of(rows, parts_by)
    if not parts:
        return []
    current = _current(spark, path, schema, parts, parts_by)
    small = sum(parts.values()) <= _SMALL_ROWS and (current is None or sizing.fits(current, _SMALL_BYTES))
    _write(_sized(merge(current, rows), *parts_by, small=small), f"{path}/{_STAGING}/{batch_id}", parts_by)
    _publish(spark, path, len(parts_by))
    return list(parts)


def read_parts(spark: SparkSession, path: str, schema: StructType, parts: Iterable[tuple], parts_by: Sequence[str]) -> DataFrame:
    """Stored rows of the partitions."""
    return spark.read.schema(schema).orc(path).where(_in_parts(parts, parts_by))


def upsert_partitioned(
    changes: DataFrame,
    path: str,
    *,
    keys: Sequence[str],
    batch_id: str | int,
    partition: str | None = "dt",
    order: Sequence[str] = ORDER,
    buckets: int = BUCKETS,
    replace: bool = False,
) -> None:
    """Fold change rows into a keyed table.

    The table is partitioned by day (unless ``partition`` is None) and by a
    hash bucket of the first key; only the partitions the batch touches are
    read and rewritten.  With ``replace`` the changes win over what is stored whatever
    their order, as results that were computed anew must.
    """
    parts_by = [partition, "bucket"] if partition else ["bucket"]
    changes = with_bucket(changes, keys[0], buckets).where(F.col("_op") != "B")

    def merge(current: DataFrame | None, rows: DataFrame) -> DataFrame:
        return apply_changes(current, rows, [*keys, "bucket"], order, replace)

    fold_partitioned(changes, path, parts_by, batch_id, merge, changes.schema)


def _logged(rows: DataFrame, path: str, batch_id: str | int) -> None:
    """A batch's rows in the log: written aside and moved in whole, so that followers never see a part of them."""
    staged = f"{path}/{_STAGING}/{batch_id}"
    _write(rows, staged)
    files.move(rows.sparkSession, staged, f"{path}/batch={batch_id}")


def log_changes(changes: DataFrame, path: str, batch_id: str | int) -> None:
    """Keep a batch's change rows for followers; a batch already logged is left as it is.

    The batch must be named by its stream too: the same number in another stream's
    checkpoint is another batch.
    """
    if not files.complete(changes.sparkSession, f"{path}/batch={batch_id}"):
        _logged(changes, path, batch_id)


def log_transitions(
    changes: DataFrame,
    path: str,
    log: str,
    *,
    keys: Sequence[str],
    batch_id: str | int,
    partition: str | None = "dt",
    order: Sequence[str] = ORDER,
    buckets: int = BUCKETS,
) -> None:
    """Keep what a batch will do to a keyed table (see :func:`transitions`) for followers.

    To be called before :func:`upsert_partitioned` with the same batch, as afterwards the old rows are gone.  A batch already
    logged is left as it is, so it does not matter how far a run got that is repeated.
    """
    spark = changes.sparkSession
    if files.complete(spark, f"{log}/batch={batch_id}"):
        return
    parts_by = [partition, "bucket"] if partition else ["bucket"]
    _publish(spark, path, len(parts_by))
    rows = with_bucket(changes, keys[0], buckets)
    parts = _parts_of(rows.where(F.col("_op") != "B"), parts_by)
    current = _current(spark, path, rows.schema, parts, parts_by) if parts else None
    _logged(transitions(current, rows, keys, order).drop("bucket"), log, batch_id)


def drop_expired(spark: SparkSession, path: str, as_of: date, before: int = 30) -> list[str]:
    """Delete the day partitions older than ``before`` days; returns their names."""
    oldest = date.fromordinal(as_of.toordinal() - before).isoformat()
    days = [n for n in files.subdirectories(spark, path) if re.fullmatch(r"(dt|day)=\d{4}-\d\d-\d\d", n)]
    expired = [n for n in days if n.partition("=")[2] < oldest]
    for name in expired:
        files.remove(spark, f"{path}/{name}")
    return expired


def multi_sink(batch: DataFrame, batch_id: str, writers: Sequence[Callable[[DataFrame, str], None]]) -> None:
    """Feed one micro-batch to several sinks, reading it once."""
    batch.persist()
    try:
        for write in writers:
            write(batch, batch_id)
    finally:
        batch.unpersist()
