import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplake.llm import topk
from shoplake.llm.queries import op10_norm_bucket_topk


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(64 * x) for x in vector]


def brute(rows, k, step=20):
    rows = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, v in {i: min(w for j, w in rows if j == i) for i, _ in rows if i % step == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def search(spark, rows, k=20, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as v", "3 as length")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k, **kw).collect())


def odd_rows():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(6)]) for i in range(120)]
    rows += [(i, [1.5, -0.25, 0.5, 0.0, 0.0, 0.0]) for i in range(120, 200)]  # copies
    rows += [(i, [0.0] * 6) for i in range(200, 230)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    return rows + [(320, []), (321, [2.0, 3.0]), (340, [1e6] * 6), (5, [9.0] * 6), (40, [0.0, 1.0])]


@pytest.mark.parametrize("bucket", [8, 2048])
@pytest.mark.parametrize("k", [1, 3, 500])
def test_against_all_products(spark, monkeypatch, bucket, k):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    assert search(spark, odd_rows(), k) == brute(odd_rows(), k)


def test_blocks_of_queries_and_near_parallel_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [x * (1 + i / 900) + rng.gauss(0, 0.02) for x in base[i % 5]]) for i in range(400)]
    assert search(spark, rows, 4, block=7) == brute(rows, 4)


def test_no_rows(spark):
    assert search(spark, []) == [] and search(spark, [(1, [1.0])]) == []


def test_sums_beyond_double_precision(spark):
    rows = [(i, [1.0e7 + i, -7.0e6, 2.0e5 * i]) for i in range(41)]
    assert search(spark, rows, 5) == brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 5)


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op10_norm_bucket_topk(spark, sf_dir).collect()) == brute(rows, 20)
