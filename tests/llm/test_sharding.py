import zlib

from pyspark.sql import functions as F

from shoplake.llm import sharding
from shoplake.llm.queries import op3_feistel_shards


def places(spark, n, key=7, steps=64):
    rows = sharding.permuted(spark.range(n).withColumnRenamed("id", "number"), "number", n, key, steps).collect()
    return [r.place for r in sorted(rows, key=lambda r: r.number)]


def test_is_a_permutation_of_any_size(spark):
    for n in (1, 2, 3, 5, 64, 65, 1000):
        assert sorted(places(spark, n)) == list(range(n))


def test_walks_on_where_one_pass_ends_early(spark):
    assert places(spark, 33, steps=1) == places(spark, 33)


def test_depends_on_the_key(spark):
    assert places(spark, 500) == places(spark, 500) != places(spark, 500, key=8)


def check(rows, given, shards=8):
    assert sorted(((r.doc_id is not None, r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        ((i is not None, i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given
    )
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(given)


def test_odd_rows(spark):
    given = [(1, None), (1, None), (1, ""), (None, "ä" * 70000), (3, "x"), (3, "x"), (3, "y")] * 5
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "9 as shard", "9 as number", "9 as size")
    check(sharding.sharded(docs).collect(), given)
    assert sharding.sharded(docs.limit(0)).collect() == []


def test_numbers_follow_the_order(spark):
    rows, n = sharding.numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")), ["k"])
    assert n == 1000 and all(r.k == r.number for r in rows.collect())


def test_query(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op3_feistel_shards(spark, sf_dir)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(rows.collect(), given)
    assert {(r.law, r.grown_shard) for r in rows.collect()} == {("rows", None)}
