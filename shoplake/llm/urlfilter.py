"""URL rules by host-suffix and path-prefix expressions.

A rule has a host and a path; it fits a URL whose host is the rule's or lies below it and whose path starts with the rule's.
Each URL is expanded into pairs of a host suffix (at label borders) and a path prefix (ending in "/", or empty), no deeper
than the deepest rule.  A rule is filed under its host and its path up to the last "/".  Both sides meet in an equi-join
on a short prefix of the pair's digest; the full digest and the rest of the rule's path are confirmed afterwards, and of the
rules that fit the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import ascii_lower

# Hex digits of the join key, and copies of each rule so that a host that holds most URLs is spread over as many tasks.
PREFIX = 8
SALTS = 16
# Copies of a row that are given as one array.
COPIES = 1 << 16


def host_of(url: Column) -> Column:
    """What lies between the first "://" and "/", "?", "#" or the end, A-Z in lower case; empty without "://"."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def filed(rules: DataFrame) -> DataFrame:
    """Rules with the digest they are filed under.  One of the same host and path blocks if any of them does.

    Rules without a host fit nothing; a null path is an empty one.
    """
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    rows = rules.where(F.length("host") > 0).select(host.alias("rule_host"), path.alias("rule_path"), "verdict")
    rows = rows.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    folder = F.regexp_extract("rule_path", r"(?s)^(.*/)", 1)
    return rows.withColumn("folder", folder).withColumn("digest", _digest(F.col("rule_host"), F.col("folder")))


def expressions(host: Column, path: Column, labels: int, folders: int) -> Column:
    """All (host, path) pairs of a URL, of so many labels and folders at most."""
    parts, steps = F.split(host, r"\."), F.split(path, "/", folders + 1)
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(labels), F.size(parts))),
        lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."),
    )
    paths = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i - 1), "/"))
    paths = F.transform(paths, lambda p, i: F.when(i == 0, F.lit("")).otherwise(F.concat(p, F.lit("/"))))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def judged(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """page_id, host, path, rule (host and path, else null) and verdict of every row.

    Null URLs and URLs without "://" have an empty host and path and get the default.  Rows that repeat are judged once
    and returned as often as they occur.  Other columns are not read.
    """
    rules = filed(rules)
    deep = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(F.size(F.split("folder", "/")) - 1).alias("folders")
    ).first()
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).groupBy("page_id", "url").count()
    urls = urls.select("page_id", "url", "count", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    pairs = expressions(F.col("host"), F.col("path"), deep.labels or 1, deep.folders or 0)
    wide = urls.select("*", F.explode(pairs).alias("pair"))
    wide = wide.withColumn("digest", _digest(F.col("pair.h"), F.col("pair.p"))).drop("pair")
    spread = rules.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    short = lambda df: df.withColumn("short", F.substring("digest", 1, PREFIX))
    met = short(wide).join(short(spread).withColumnRenamed("digest", "rule_digest"), ["short", "salt"], "left")
    fits = (F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    found = F.when(fits, F.struct(F.length(rule), F.length("rule_host"), rule.alias("rule"), "rule_verdict"))
    best = met.groupBy("page_id", "url", "count", "host", "path").agg(F.max(found).alias("best"))
    verdict = F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")
    rows = best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict, "count")
    # A row with very many copies gives them run by run, never as one array.
    runs = F.sequence(F.lit(0).cast("long"), F.expr(f"(count - 1) div {COPIES}"))
    rows = rows.withColumn("_run", F.explode(runs))
    here = F.least(F.lit(COPIES), F.col("count") - F.col("_run") * COPIES).cast("int")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), here))).drop("count", "_run", "_copy")
