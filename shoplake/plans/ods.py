"""Raw layer: source columns as declared, plus the day ``dt`` of facts and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.functions import day_text

# Key of each keyed table; logs and the order status log are append-only.
KEYS = {
    **{t: ("id",) for t in schemas.BASE_TABLES},
    **{t: ("id", "dt") for t in schemas.BUSINESS_TABLES if t != "order_status_log"},
}


def event_time(table: str) -> str | None:
    """The column ``dt`` comes from; None for base tables, which have no day."""
    if table in schemas.BASE_TABLES:
        return None
    return schemas.EVENT_TIME.get(table, "create_time")


def load(table: str, rows: DataFrame) -> DataFrame:
    """Rows of a source table as the raw table stores them."""
    out = schemas.conform(rows, table)
    time = event_time(table)
    return out.withColumn("dt", day_text(F.col(time))) if time else out
