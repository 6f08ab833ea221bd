"""Where the lake's tables are, and reading them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from shoplake import schemas
from shoplake.operators import files, sizing
from shoplake.operators.changelog import live_rows
from shoplake.operators.sinks import BUCKETS, current_version



def scratch_root(spark: SparkSession) -> str:
    """A new folder that every executor can reach.

    It lies in the checkpoint folder.  Without one, a session whose executors run
    in the driver's process gets a temporary folder; any other is refused, as its
    executors would write to disks of their own.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="shoplake-")
    return f"{shared.rstrip('/')}/shoplake-{uuid.uuid4().hex}"


class Lake:
    """Tables under one root, named ``layer.table``.

    Each keyed table has a change log beside it, which jobs downstream follow.
    ``buckets`` is how many pieces a day of a keyed table is cut into; an upsert
    rewrites the pieces it touches.  The count a lake was made with is stored in it
    and holds from then on.  ``checkpoints`` is where its streams keep their progress.
    """

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = BUCKETS, checkpoints: str | None = None
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._counted: dict[str, tuple[str, int]] = {}
        self.checkpoints = checkpoints or f"{self.root}/checkpoints"
        made = [n for n in files.subdirectories(spark, f"{self.root}/_buckets") if n.startswith("n=")]
        if not made:
            files.make(spark, f"{self.root}/_buckets/n={buckets}")
        self.buckets = int(made[0][2:]) if made else buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def changes(self, name: str) -> str:
        path = f"{self.root}/changes/{name.replace('.', '/')}"
        files.make(self.spark, path)
        return path

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoints}/{name.replace('.', '/')}"

    def stored(self, name: str) -> DataFrame | None:
        """The table's current rows, listed anew at every call; None if nothing is stored."""
        path = self.path(name)
        version = current_version(self.spark, path)
        if version:
            return self._sized(name, version)
        tables = [d for d in files.subdirectories(self.spark, path) if not d.startswith("_")]
        if not tables:
            return None
        df = self.spark.read.orc(path)
        if "day" in df.columns:
            # The directory's day prunes, the files' copy does not.
            df = df.drop("dt").withColumnRenamed("day", "dt")
        if "dt" in df.columns:
            day = "date" if name.startswith("dws.") else "string"
            df = df.withColumn("dt", df["dt"].cast(day))
        df = live_rows(df) if "_op" in df.columns else df
        return df.drop("bucket", "batch")

    def _sized(self, name: str, version: str) -> DataFrame:
        """A version of a snapshot and how many rows it has, counted once."""
        df = self.spark.read.orc(version)
        known = self._counted.get(name)
        if known is None or known[0] != version:
            known = self._counted[name] = version, df.count()
        return sizing.note_rows(df, known[1])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """No rows of a source table, typed."""
    ddl = ", ".join(f"{c} {t}" for c, t in schemas.fields(table).items())
    return spark.createDataFrame([], ddl)
