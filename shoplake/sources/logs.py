"""JSON event logs, read tolerantly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.operators.gate import reasons


def parse_log(text: DataFrame, table: str) -> DataFrame:
    """Text column ``value`` to typed log rows.

    A missing field or one that does not fit its type is NULL; unknown fields
    are ignored; a record that is not a JSON object is dropped.
    """
    columns = schemas.fields(table)
    # A generator parses each record once; a plain column would be parsed again for every use.
    parsed = F.inline(F.array(F.from_json("value", schemas.text_ddl(table))))
    rows = text.select(F.col("value").alias("_text"), parsed)
    found = F.coalesce(*columns).isNotNull()
    # Only a record without any known field needs the second look that tells "{}" from broken text.
    rows = rows.where(F.ltrim("_text").startswith("{") & (found | F.json_object_keys("_text").isNotNull()))
    return rows.select(*[schemas.from_text(F.col(c), t).alias(c) for c, t in columns.items()])


def checked_log(text: DataFrame, table: str) -> DataFrame:
    """Like :func:`parse_log`, but no record is dropped: ``_bad`` lists what is wrong with it and ``_text`` is its text.

    A record is wrong if it is no JSON object, if a field has text that does not fit its type, or if the time is missing.
    """
    columns = schemas.fields(table)
    # The parser may give a null instead of an object, which a plain generator would lose.
    parsed = F.inline(F.array(F.struct(F.from_json("value", schemas.text_ddl(table)).alias("_row"))))
    rows = text.select(F.col("value").alias("_text"), parsed).select("_text", "_row.*")
    found = F.coalesce(*columns).isNotNull()
    whole = F.ltrim("_text").startswith("{") & (found | F.json_object_keys("_text").isNotNull())
    typed = {c: schemas.from_text(F.col(c), t) for c, t in columns.items()}
    checks = {f"bad {c}": whole & F.col(c).isNotNull() & v.isNull() for c, v in typed.items()}
    time = schemas.EVENT_TIME.get(table, "create_time")
    bad = reasons({"no JSON object": ~F.coalesce(whole, F.lit(False)), f"no {time}": whole & F.col(time).isNull(), **checks})
    return rows.select(*[v.alias(c) for c, v in typed.items()], bad.alias("_bad"), "_text")


def json_log_stream(
    spark: SparkSession, table: str, source: str | dict, max_files: int | None = None, checked: bool = False
) -> DataFrame:
    """Streaming log rows from a directory of JSON-lines files or Kafka options.

    A new query starts at the earliest record; a restarted one goes on where
    its checkpoint ends.  ``checked`` rows say what is wrong with them.
    """
    parse = checked_log if checked else parse_log
    if isinstance(source, dict):
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**source)
        return parse(reader.load().select(F.col("value").cast("string")), table)
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse(reader.load(source), table)
