"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# The JVM never compiles a method of more than 8,000 bytes of code, and a stage of a wide table (typing 19 columns of text,
# summing a dozen measures) easily makes one, which is then interpreted row by row.  Such stages go without whole-stage code.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Run-time re-planning: coalesce small shuffle partitions, turn sort-merge joins
# into broadcast joins once the true size is known, and split skewed join
# partitions (a hot user or sku) even when that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session someone else made."""
    for key, value in {**ADAPTIVE, **COMPILED}.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "shoplake", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; zone pinned to UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHOPLAKE_SHUFFLE", "8"))
        .config("spark.driver.memory", os.environ.get("SHOPLAKE_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**ADAPTIVE, **COMPILED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
