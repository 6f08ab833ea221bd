"""Row changes of keyed tables: the source's change records and the lake's own change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.operators import files
from shoplake.operators.changelog import position


def cdc_records(text: DataFrame, table: str) -> DataFrame:
    """Text column ``value`` to change records ``(op, ts_ms, seq, before, after)``.

    Records that are not JSON or lack an operation are dropped.  Row images
    are typed; text that does not fit its column gives NULL.  ``seq`` becomes a position: of the record's ``source``
    (``file`` ending in its number, ``pos``, ``row``), or else of its plain ``seq``.
    """
    wire = schemas.text_ddl(table)
    image = f"struct<{wire.replace(' string', ': string')}>"
    source = "struct<file: string, pos: bigint, row: bigint, ts_ms: bigint>"
    fields = f"op string, ts_ms bigint, seq bigint, source {source}, before {image}, after {image}"
    envelope = F.from_json("value", fields)
    # A generator parses each record once; a plain column would be parsed again for every use.
    rows = text.select(F.inline(F.array(envelope))).where(F.col("op").isin("r", "c", "u", "d"))

    def typed(name: str):
        cols = [schemas.from_text(F.col(f"{name}.{c}"), t).alias(c) for c, t in schemas.fields(table).items()]
        return F.when(F.col(name).isNotNull(), F.struct(*cols)).alias(name)

    number = F.coalesce(F.regexp_extract("source.file", r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    placed = position(number, F.col("source.pos"), F.coalesce("source.row", F.lit(0)))
    seq = F.when(F.col("source.pos").isNotNull(), placed).otherwise(position(0, F.col("seq"))).alias("seq")
    return rows.select("op", F.coalesce("source.ts_ms", "ts_ms").alias("ts_ms"), seq, typed("before"), typed("after"))


def cdc_stream(
    spark: SparkSession,
    table: str,
    source: str | dict,
    *,
    start: str = "initial",
    since_ms: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming change records of a source table.

    ``source`` is a directory of JSON-lines files or Kafka options (the Kafka
    package must be on the class path).  ``start="initial"`` reads everything from the
    beginning; the rows that existed before come as ``r`` records or through
    :meth:`shoplake.streaming.Jobs.load_snapshot`.  ``start="latest"`` reads only what
    arrives later: Kafka's latest offsets, or for files changes from
    ``since_ms`` on.
    """
    if start not in ("initial", "latest"):
        raise ValueError(start)
    if isinstance(source, dict):
        offsets = "earliest" if start == "initial" else "latest"
        reader = spark.readStream.format("kafka").option("startingOffsets", offsets).options(**source)
        return cdc_records(reader.load().select(F.col("value").cast("string")), table)
    if start == "latest" and since_ms is None:
        raise ValueError("files need since_ms to start at the latest change")
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = cdc_records(reader.load(source), table)
    return records.where(F.col("ts_ms") >= since_ms) if start == "latest" else records


def change_stream(
    spark: SparkSession, path: str, columns: Sequence[tuple[str, str]], max_files: int | None = None
) -> DataFrame:
    """Follow a lake table: the change log of a keyed table or the files of an append-only one.

    ``columns`` are its names and types; the directory may still be empty.
    """
    files.make(spark, path)
    names = [name for name, _ in columns]
    reader = spark.readStream.format("orc").schema(", ".join(f"`{name}` {typ}" for name, typ in columns))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(*names)
