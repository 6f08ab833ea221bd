"""Operators on hand-made rows, against brute force where rules are involved."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplake.functions import growth_pct, pct, ratio
from shoplake.operators import (
    affected_groups,
    apply_changes,
    audit_row_counts,
    change_rows,
    explode_ids,
    flatten_tree,
    funnel,
    latest_nonempty_day,
    live_rows,
    lookup_join,
    rank_by,
    retain_window,
    retention,
    rfm,
    top_by,
)
from shoplake.operators.models import SEGMENTS
from shoplake.sources import cdc_records, jdbc_options, parse_log, snapshot_scan
from shoplake.operators import sizing
from shoplake.operators.lake import Lake
from shoplake.operators.sinks import overwrite_snapshot
from shoplake.streaming import replay


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# --- lookups ---------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 60, 0])
def test_lookup_join_keeps_every_fact(spark, limit):
    fact = spark.createDataFrame([(1, 10, "a"), (2, None, "a"), (3, 99, "a"), (4, 0, "b"), (5, 10, "b")], "id int, k long, t string")
    dim = spark.createDataFrame([(10, "ten"), (0, "zero")], "k long, v string")
    got = lookup_join(fact, dim, ("k", "k"), {"name": "v"}, cond=F.col("t") == "a", broadcast_bytes=limit)
    assert got.columns == ["id", "k", "t", "name"]
    assert tuples(got, "id", "name") == [(1, "ten"), (2, None), (3, None), (4, None), (5, None)]
    got = lookup_join(fact, dim, ("k", "k"), {"name": "v"}, broadcast_bytes=limit)
    assert tuples(got, "id", "name") == [(1, "ten"), (2, None), (3, None), (4, "zero"), (5, "ten")]


def test_large_dimension_is_not_broadcast_and_null_keys_are_spread(spark):
    fact = spark.range(0, 100_000, numPartitions=4).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"))
    dim = spark.range(0, 1000, numPartitions=4).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(fact, dim, ("k", "k"), {"v": "v"}, broadcast_bytes=0)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 100_000
        assert max(sizes) < 2 * 100_000 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_dimension_file_is_broadcast(spark, sf_dir):
    fact = spark.read.parquet(f"{sf_dir}/customer.parquet")
    dim = spark.read.parquet(f"{sf_dir}/nation.parquet")
    plan = lookup_join(fact, dim, ("c_nationkey", "n_nationkey"), {"n": "n_name"})._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_flatten_tree(spark):
    rows = [(1, "top", None), (11, "mid", 1), (111, "leaf", 11), (222, "orphan", 99)]
    flat = flatten_tree(spark.createDataFrame(rows, "id long, category_name string, parent_id long"))
    names = ["id", "category3_name", "category2_name", "category1_name"]
    assert tuples(flat, *names) == [
        (1, "top", None, None),
        (11, "mid", "top", None),
        (111, "leaf", "mid", "top"),
        (222, "orphan", None, None),
    ]


def test_explode_ids(spark):
    rows = [("a", "1,2,3"), ("b", "7"), ("c", "1,,2"), ("d", ""), ("e", None), ("f", "x,1")]
    got = explode_ids(spark.createDataFrame(rows, "k string, ids string"), "ids")
    assert tuples(got, "k", "sku_id") == sorted(
        [("a", 1), ("a", 2), ("a", 3), ("b", 7), ("c", 1), ("c", None), ("c", 2), ("d", None), ("f", None), ("f", 1)],
        key=repr,
    )
    dots = explode_ids(spark.createDataFrame([("1.2",)], "ids string"), "ids", sep=".")
    assert tuples(dots, "sku_id") == [(1,), (2,)]


# --- changes ---------------------------------------------------------------------


def test_changes_fold_like_a_replay(spark):
    """Random changes in random arrival order equal a replay in source order."""
    rng = random.Random(7)
    state, log, schema = {}, [], "id long, v long, _op string, _ts long, _seq long"
    for seq in range(400):
        key = 1 if rng.random() < 0.4 else rng.randrange(20)
        if rng.random() < 0.2:
            state.pop(key, None)
            log.append((key, None, "D", seq // 3, seq))
        else:
            state[key] = seq
            log.append((key, seq, "U", seq // 3, seq))
    rng.shuffle(log)
    current = None
    for i in range(0, 400, 100):
        current = apply_changes(current, spark.createDataFrame(log[i : i + 100], schema), ["id"])
    assert tuples(live_rows(current), "id", "v") == sorted(state.items(), key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 1).alias("id"), F.col("id").alias("_ts"), F.lit(0).alias("_seq"), F.lit("U").alias("_op"))
    plan = apply_changes(None, rows, ["id"])._jdf.queryExecution().executedPlan().toString()
    # Printed top down: the partial limit is below the exchange.
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]
    assert apply_changes(None, rows, ["id"]).first()._ts == 999


def test_change_rows_of_updates_and_moves(spark):
    def image(id, amount, day):
        return {"id": id, "total_amount": amount, "create_time": f"{day} 01:00:00"}

    import json

    a, b, c = image(1, 1, "2024-01-01"), image(1, 2, "2024-01-01"), image(1, 2, "2024-01-02")
    records = [("c", 1, None, a), ("u", 2, a, b), ("u", 3, b, c), ("d", 4, c, None)]
    text = [(json.dumps({"op": o, "ts_ms": 5, "seq": s, "before": x, "after": y}),) for o, s, x, y in records]
    text += [("{",), ("[]",), ('{"op": "q"}',), (None,)]
    rows = change_rows(cdc_records(spark.createDataFrame(text, "value string"), "order_info"), ["id", "dt"], "create_time")
    assert tuples(rows.withColumn("_seq", F.col("_seq.pos")), "_seq", "_op", "dt", F.col("total_amount").cast("int")) == [
        (1, "U", "2024-01-01", 1),
        (2, "B", "2024-01-01", 1),
        (2, "U", "2024-01-01", 2),
        (3, "D", "2024-01-01", 2),
        (3, "U", "2024-01-02", 2),
        (4, "D", "2024-01-02", 2),
    ]
    facts = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-03"), (2, "2024-01-01")], "id long, dt string")
    assert tuples(affected_groups(rows, facts, ["id", "dt"]), "id", "dt") == [(1, "2024-01-01")]


# --- sources ---------------------------------------------------------------------


def test_tolerant_logs(spark):
    text = [
        '{"mid": "a", "user_id": 1, "err_code": "E1", "create_time": "2024-01-01 10:00:00.123", "extra": [1]}',
        '{"mid": "b", "user_id": "many"}',
        '{"mid": "c", "user_id": "12"}',
        '{"mid": "d", "user_id": 1.5}',
        '{"mid": "e", ',
        "plain text",
        "[1, 2]",
        "{}",
        "",
        None,
    ]
    rows = parse_log(spark.createDataFrame([(t,) for t in text], "value string"), "log_error")
    assert tuples(rows, "mid", "user_id", "err_code", F.col("create_time").cast("string")) == sorted(
        [
            ("a", 1, "E1", "2024-01-01 10:00:00.123"),
            ("b", None, None, None),
            ("c", 12, None, None),
            ("d", None, None, None),
            (None, None, None, None),
        ],
        key=repr,
    )


def test_change_times_as_text_or_epoch(spark):
    text = [
        '{"op": "c", "ts_ms": 1, "seq": 1, "after": {"id": 1, "birthday": "2000-02-03", "create_time": 1704103200123}}',
        '{"op": "c", "ts_ms": 1, "seq": 2, "after": {"id": 2, "birthday": 10990, "create_time": "2024-01-01 10:00:00"}}',
    ]
    rows = cdc_records(spark.createDataFrame([(t,) for t in text], "value string"), "user_info").select("after.*")
    assert tuples(rows, "id", F.col("birthday").cast("string"), F.col("create_time").cast("string")) == [
        (1, "2000-02-03", "2024-01-01 10:00:00.123"),
        (2, "2000-02-03", "2024-01-01 10:00:00"),
    ]


def test_snapshot_scan_reads_declared_columns(spark, sf_dir, tmp_path):
    rename = {"id": "n_nationkey", "region_name": "n_name"}
    rows = snapshot_scan(spark, "base_region", path=f"{sf_dir}/nation.parquet", rename=rename)
    assert rows.count() == 25 and dict(rows.dtypes)["id"] == "bigint"
    assert "n_regionkey" not in rows.where("id > 3")._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "b.json").write_text('{"id": 1, "brand_name": "x"}\n')
    assert snapshot_scan(spark, "base_brand", path=str(tmp_path), format="json").first().brand_name == "x"
    with pytest.raises(ValueError):
        snapshot_scan(spark, "base_brand")
    options = jdbc_options("jdbc:mysql://db/shop", "base_brand", (1, 1000), 4, user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4" and options["fetchsize"] == "200"


def test_audit(spark):
    assert tuples(audit_row_counts({"a": spark.range(3), "b": spark.range(0)}), "name", "cnt") == [("a", 3), ("b", 0)]


# --- ranks -----------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 62, 0])
def test_rank_by_equals_sorting(spark, limit):
    """A day of equal measures, NULL measures and NULL days: both ways number every row."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        day = rng.choice(["2024-01-01"] * 4 + ["2024-01-02", None])
        rows.append((day, i, rng.choice([0, 0, 0, None, rng.randrange(50)]), Decimal(rng.randrange(900)) / 100))
    df = spark.createDataFrame(rows, "dt string, id long, n long, amount decimal(18,2)").repartition(3)
    got = rank_by(df, ["dt"], {"rn": "n", "ra": "amount"}, ["id"], single_group_bytes=limit)
    assert got.columns == ["dt", "id", "n", "amount", "rn", "ra"]
    ranks = {r.id: (r.rn, r.ra) for r in got.collect()}
    want = {}
    for day in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == day]
        by_n = sorted(here, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        by_amount = sorted(here, key=lambda r: (-r[3], r[1]))
        for i, r in enumerate(by_n):
            want[r[1]] = [i + 1]
        for i, r in enumerate(by_amount):
            want[r[1]].append(i + 1)
    assert ranks == {k: tuple(v) for k, v in want.items()}


def test_large_ranks_are_cut_into_ranges(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit("d").alias("dt"), "id", F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = rank_by(df, ["dt"], {"rn": "n"}, ["id"], single_group_bytes=0)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 10_000
        assert got.where("rn != id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_by_limits_before_the_shuffle(spark):
    rows = spark.range(500).select((F.col("id") % 2).alias("dt"), "id", (F.col("id") % 7).alias("n"))
    top = top_by(rows, ["dt"], "n", ["id"], 3)
    got = sorted(tuple(r) for r in top.select("dt", "rn", "id").collect())
    assert [(d, i, n) for d, n, i in got] == [(0, 6, 1), (0, 20, 2), (0, 34, 3), (1, 13, 1), (1, 27, 2), (1, 41, 3)]
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


# --- models ----------------------------------------------------------------------


def test_funnel(spark):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "user_id long, dt string")

    stages = [
        ("browse", rows((1, "2024-01-01"), (1, "2024-01-01"), (None, "2024-01-01"))),
        ("action", rows((2, "2024-01-01"))),
        ("cart", rows((1, "2024-01-01"), (1, "2024-01-02"))),
        ("order", rows((2, "2024-01-02"))),
    ]
    got = tuples(funnel(stages), F.col("dt").cast("string"), "browse_users", "action_users", "cart_users", "order_users")
    assert got == [("2024-01-01", 2, 1, 1, 0), ("2024-01-02", 2, 0, 1, 1)]


def test_retention(spark):
    days = {1: [0, 1, 7], 2: [0], 3: [0, 30], 4: [0, 2], 5: [10, 11]}
    rows = [(u, date.fromordinal(date(2024, 1, 1).toordinal() + d)) for u, ds in days.items() for d in ds]
    rows.append((6, None))
    got = retention(spark.createDataFrame(rows, "user_id long, dt date"), "new", "d{}", "r{}")
    assert tuples(got, F.col("dt").cast("string"), "new", "d1", "d7", "d30", "r1", "r7", "r30") == [
        ("2024-01-01", 4, 1, 1, 1, 25.0, 25.0, 25.0),
        ("2024-01-11", 1, 1, 0, 0, 100.0, 0.0, 0.0),
    ]


def test_rfm_segments_and_means(spark):
    rows = []
    for user, (r, f, m) in enumerate(SEGMENTS):
        # recent users ordered on the last day; frequent ones have 3 orders, large ones 300.
        rows.append((user, f"u{user}", 1, date(2024, 1, 30 if r else 10), 3 if f else 1, Decimal(300 if m else 100)))
    df = spark.createDataFrame(rows, "user_id long, user_nick_name string, user_level int, dt date, order_count long, order_total_amount decimal(18,4)")
    got = {r.user_id: r.user_segment for r in rfm(df, date(2024, 2, 1)).collect()}
    assert got == dict(enumerate(SEGMENTS.values()))
    # Everybody equal: at the mean counts as recent, frequent and large.
    same = df.withColumn("dt", F.lit("2024-01-10").cast("date")).withColumn("order_count", F.lit(2)).withColumn(
        "order_total_amount", F.lit("10.01").cast("decimal(18,4)")
    )
    assert {r.user_segment for r in rfm(same, date(2024, 2, 1)).collect()} == {"高价值用户"}


def test_ratios_round_half_up(spark):
    row = spark.range(1).select(
        ratio(F.lit("301148.535").cast("decimal(28,4)"), F.lit(3), 2).alias("mean"),
        pct(F.lit(1), F.lit(800)).alias("eighth"),
        pct(F.lit(1), F.lit(0)).alias("zero"),
        growth_pct(F.lit(1), F.lit(3)).alias("drop"),
        ratio(F.lit(1), F.lit(0)).alias("undefined"),
    ).first()
    assert tuple(row) == (100382.85, 0.13, 0.0, -66.67, None)


def test_days(spark):
    rows = spark.createDataFrame([(date(2024, 1, d), d % 3) for d in range(1, 31)], "dt date, n int")
    assert retain_window(rows, date(2024, 1, 20), before=5, after=3).count() == 9
    latest = latest_nonempty_day(rows, F.col("n") > 0)
    assert [str(r.dt) for r in rows.where(F.col("dt") == latest).collect()] == ["2024-01-29"]


# --- sizes -----------------------------------------------------------------------


def test_replayed_records_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "_LINES", 300)
    replay.write_records(spark.range(1000).coalesce(1), str(tmp_path / "in"))
    names = [p.name for p in (tmp_path / "in").iterdir() if p.name.startswith("part-")]
    assert len(names) == 4 and all(n.endswith(".gz") for n in names)
    assert spark.read.json(str(tmp_path / "in")).agg(F.count_distinct("id")).first()[0] == 1000


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    """A stored dimension's rows decide, as its files may be compressed to almost nothing."""
    lake = Lake(spark, str(tmp_path / "lake"))
    fact = spark.range(10).withColumnRenamed("id", "k")
    for rows, broadcast in ((1_000, True), (500_000, False)):
        overwrite_snapshot(spark.range(rows).withColumn("v", F.lit("x")), lake.path("dim.user_info"))
        dim = lake.stored("dim.user_info")
        assert sizing.fits(dim, sizing.BROADCAST_BYTES)
        joined = lookup_join(fact, dim, ("k", "id"), {"v": "v"})
        assert ("strategy=broadcast" in joined._jdf.queryExecution().optimizedPlan().toString()) == broadcast
        assert joined.where("v = 'x'").count() == 10


def test_spark_does_not_broadcast_a_large_dimension_of_small_files(spark, tmp_path):
    """Left to itself Spark goes by the size of the files, which is far below its threshold here."""
    lake = Lake(spark, str(tmp_path / "lake"))
    overwrite_snapshot(spark.range(500_000).withColumn("v", F.lit("x")), lake.path("dim.user_info"))
    dim = lake.stored("dim.user_info")
    assert sizing.input_bytes(dim) < 10 * sizing.MB
    joined = lookup_join(spark.range(10).withColumnRenamed("id", "k"), dim, ("k", "id"), {"v": "v"})
    assert joined.where("v = 'x'").count() == 10
    plan = joined._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" in plan.toString() and "BroadcastHashJoin" not in plan.toString()
