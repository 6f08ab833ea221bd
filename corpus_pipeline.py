"""Stages that clean a corpus and pack it for training, one after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import decontaminate, neardup, packing, pii, toxicity
from shoplake.llm.common import once, saved, table, without

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not hold to be toxic.

    A null or empty text is judged as one without a match; rows that repeat are judged alike.
    """
    return toxicity.kept(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a hash of their text, and that column's name, which no other column has.

    An id may be repeated with another text, so id and hash name a row.
    """
    name = "text_hash"
    while name in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return docs.withColumn(name, F.xxhash64("text")), name


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; of exact repeats of a row, one.

    Documents without words, null texts too, are linked with nothing.
    """
    gone = neardup.classified(docs).where("not first").select("doc_id", "text_hash")
    rows, name = _named(docs)
    return once(without(rows, gone, "doc_id", name), "doc_id", name).drop(name)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages; a null or empty text never is, repeats go together."""
    found = decontaminate.matched(docs, table(spark, sf_dir, "benchmark"))
    gone = found.where(decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit"))).select("doc_id", "text_hash")
    rows, name = _named(docs)
    return without(rows, gone, "doc_id", name).drop(name)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and `n_chars`, if they have it, counted again.

    A null text stays null, with null characters; repeats are masked alike.
    """
    rows = pii.redacted(docs, pii.trained(docs))
    if "n_chars" not in docs.columns:
        return rows
    return rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids (little-endian unsigned 32-bit) and their places in sequences of 4096.

    A null or empty text is the end id alone; every repeat is packed; no documents give no pieces.
    """
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), 1, 4096)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("near_dedup", near_duplicate),
    ("decontamination", benchmark),
    ("pii", personal),
    ("packing", pack),
]

# Toxicity, personal data and packing learn or search in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
