import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplake.llm import hardneg


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector]


def brute(rows, step=50, positives=5, negatives=3):
    rows = [(i, int(y), w) for i, v, y in rows if i is not None and y is not None and (w := whole(v)) is not None]
    out = []
    for a in sorted({i for i, _, _ in rows if i % step == 0}):
        _, label, v = min(r for r in rows if r[0] == a)
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, y == label) for i, y, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            near = [(t, i) for t, i, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(near[:negatives])]
    return sorted(out)


def mine(spark, rows, step=50, parts=3, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 as block", "2 as v", "3 as part", "4 as score").repartition(parts)
    return sorted(tuple(r) for r in hardneg.mined(df, F.col("vec_id") % step == 0, **kw).collect())


def cloud(n, dims, seed, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 1), (2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_and_moves_by_one(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in hardneg.hilbert_keys(cells, bits)]
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert len(set(keys)) == len(keys) and set(np.abs(np.diff(path, axis=0)).sum(1)) == {1}


@pytest.mark.parametrize("bits", [2, 8])
def test_against_all_products(spark, monkeypatch, bits):
    monkeypatch.setattr(hardneg, "BLOCK_BITS", bits)
    rows = cloud(400, 6, 1)
    assert mine(spark, rows, step=10) == brute(rows, step=10) != []


def test_blocks_of_anchors(spark):
    rows = cloud(150, 4, 2)
    assert mine(spark, rows, step=3, block=7) == brute(rows, step=3)


def test_odd_rows(spark):
    rows = cloud(120, 4, 3)
    rows += [(i, [0.5, 0.25, -0.5, 1.0], i % 3) for i in range(200, 290)]  # copies and ties
    rows += [(300, None, 1), (301, [1.0, None], 1), (350, [float("nan")] * 4, 1), (303, [float("inf")] * 4, 1)]
    rows += [(None, [1.0] * 4, 1), (304, [1.0] * 4, None), (400, [], 1), (450, [2.0, 3.0], 9), (500, [0.0] * 4, 2)]
    rows += [(50, [0.5, 0.5, 0.5, 0.5], 3), (50, [0.5, 0.5, 0.5, 0.5], 3), (7, [0.1] * 4, 0), (7, [0.9] * 4, 1)]
    assert mine(spark, rows) == brute(rows) != []


def test_no_rows_one_label_and_negative_scores(spark):
    assert mine(spark, []) == [] and mine(spark, [(50, [1.0], 1)]) == []
    same = [(i, [1.0, i / 10], 1) for i in range(60)]
    assert mine(spark, same) == []
    apart = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.8, 0.0], 2)]
    assert mine(spark, apart) == brute(apart) == []


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_BITS", 4)
    rng = random.Random(4)
    far = [(i, [(10 if i % 8 == d else 0) + rng.gauss(0, 0.05) for d in range(8)], i % 2) for i in range(1, 1200)]
    rows = [(0, [10.0] + [0.0] * 7, 0), *far]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label long")
    df = df.selectExpr("vec_id", "label", "transform(v, x -> floor(256 * x)) as v")
    blocks, zones = hardneg.blocked(df, 8)
    anchors = hardneg._Anchors(df.where("vec_id = 0").selectExpr("*", "1L as copies").toArrow(), 8)
    anchors.bar = np.floor(hardneg._guaranteed(zones, anchors, 5)).astype(np.int64)
    wanted = sum(bool(hardneg._for_positives(anchors, *anchors.bounds(lo, hi), labels)[0]) for _, _, lo, hi, labels, _ in
                 hardneg._each_zone(zones.toArrow().to_batches()))
    assert anchors.bar[0] > 0 and 0 < wanted < zones.count() / 4
    assert zones.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] == len(rows) == blocks.count()


def test_sums_beyond_double_precision(spark):
    rows = [(i, [1.0e6 + i, -7.0e5, 2.0e4 * i], i % 2) for i in range(101)]
    assert mine(spark, rows) == brute([(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows])
