"""What the corpus operators share: the shared folder, written tables and input columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session whose executors live in the driver's process may go without; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="shoplake-"))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of the shared one that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read back, which cuts the lineage."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes from which on an Arrow batch takes no further row; Spark's own 64 MB are held several times by each task, outside the heap.
BATCH_BYTES = 4 << 20
_MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(rows: DataFrame, f: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`mapInArrow` in batches that are bounded by their bytes too, as texts and sets differ in length a thousandfold.

    The session keeps a bound that its user has set.
    """
    conf = rows.sparkSession.conf
    if conf.get(_MOST_BYTES, None) is None:
        conf.set(_MOST_BYTES, str(BATCH_BYTES))
    return rows.mapInArrow(f, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


# Buckets of key hashes that may be sent to every task: a million numbers at most, whatever the tables.
BUCKETS = 1 << 20


def _bucket(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _marked(keys: DataFrame) -> DataFrame:
    """The buckets that the keys fall into."""
    return F.broadcast(keys.select(_bucket(*(keys[c] for c in keys.columns)).alias("_marked")).distinct())


def near(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows that may have one of the keys (columns of both): all that have, and few others while the keys are few.

    Made to go before a join on the keys, so that most rows need not be shuffled for it.
    """
    marked = _marked(keys)
    return rows.join(marked, _bucket(*(rows[c] for c in keys.columns)) == marked["_marked"], "left_semi")


def _same(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[k])
    return same


def without(rows: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are not among `ids` (as many columns); null is a key.  Only rows in a marked bucket are shuffled."""
    ids = ids.select(*(ids[c].alias(k) for c, k in zip(ids.columns, keys, strict=True))).distinct()
    marked = _marked(ids)
    clean = rows.join(marked, _bucket(*(rows[k] for k in keys)) == marked["_marked"], "left_anti")
    rest = near(rows, ids)
    return clean.unionAll(rest.join(ids, _same(rest, ids, keys), "left_anti"))


def once(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of those that share their keys, the first by its columns' JSON text; null is a key.

    Columns may be of any type, such as maps, that cannot be ordered.  Only rows in a repeated key's bucket are shuffled.
    """
    again = saved(rows.groupBy(*keys).count().where("count > 1").select(*keys), "repeated")
    marked = _marked(again)
    bucket = _bucket(*(rows[k] for k in keys))
    single = rows.join(marked, bucket == marked["_marked"], "left_anti")
    others = [c for c in rows.columns if c not in keys]
    row = F.struct(*others)
    least = near(rows, again).groupBy(*keys).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return single.unionAll(least.select(*(c if c in keys else F.col("_row")[c].alias(c) for c in rows.columns)))
