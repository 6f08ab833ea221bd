"""Spans of a text (kind, start, end; code points, end exclusive) and their digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"


def in_order(spans: Sequence[tuple[str, int, int]], kinds: Sequence[str]) -> list[tuple[str, int, int]]:
    """By start, then by the kinds' order."""
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, with commas between them."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digests(found: DataFrame, base: Sequence[str]) -> DataFrame:
    """doc_id, the number of spans of each base kind, the base spans' sha256, and all spans as text.

    `found` has `base`, the spans that the contract fixes, and `spans`, those and what the method adds.
    """

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, base)
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
