"""Bounded reads: whole tables from files or a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shoplake import schemas

_FETCH_SIZE = 200


def jdbc_options(url: str, table: str, bounds: tuple[int, int] | None = None, partitions: int = 8, **more: str) -> dict:
    """Options of a JDBC read, cut into ``partitions`` ranges of ``id`` when its bounds are given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(_FETCH_SIZE), **more}
    if bounds:
        options |= {
            "partitionColumn": "id",
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def snapshot_scan(
    spark: SparkSession,
    table: str,
    *,
    path: str | None = None,
    format: str = "parquet",
    jdbc: Mapping[str, str] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows of a source table, in its declared columns.

    Reads files under ``path`` or the table behind ``jdbc`` options (the
    database's driver must be on the class path).  ``rename`` maps declared
    columns to differently named source columns; only declared columns are read.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc")
    if jdbc is not None:
        rows = spark.read.format("jdbc").options(**jdbc).load()
    elif format in ("json", "csv"):
        ddl = ", ".join(f"{(rename or {}).get(c, c)} {t}" for c, t in schemas.fields(table).items())
        rows = spark.read.format(format).schema(ddl).load(path)
    else:
        rows = spark.read.format(format).load(path)
    for column, name in (rename or {}).items():
        rows = rows.withColumnRenamed(name, column)
    return schemas.conform(rows, table)
