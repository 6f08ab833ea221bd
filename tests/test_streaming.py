"""Streams fed in several batches must end where the batch plans do."""

import json
from pathlib import Path

import pytest

from shoplake import schemas
from shoplake.operators import files
from shoplake.operators.lake import Lake
from shoplake.operators.sinks import drop_expired
from shoplake.plans import dws
from shoplake.plans.warehouse import RULES
from shoplake.streaming import Jobs
from shoplake.streaming.jobs import await_all


def put(folder: Path, number: int, records: list) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / f"{number:04d}.json").write_text("\n".join(lines) + "\n")


def change(op, seq, before=None, after=None, ts=1000):
    return {"op": op, "ts_ms": ts + seq, "seq": seq, "before": before, "after": after}


def order(id, user=1, amount="10.00", day="2024-01-01", **more):
    return {"id": id, "user_id": user, "total_amount": amount, "original_total_amount": amount,
            "coupon_reduce_amount": "0.00", "province_id": 1, "create_time": f"{day} 10:00:00", **more}


@pytest.fixture
def jobs(spark, tmp_path):
    jobs = Jobs(Lake(spark, str(tmp_path / "lake")), {"availableNow": True}, max_files=1)
    users = [(1, "ann", 2, 1), (2, "bob", 3, 2)]
    jobs.load_snapshot("user_info", spark.createDataFrame(users, "id long, nick_name string, user_level int, gender int"))
    jobs.load_snapshot("base_region", spark.createDataFrame([(1, "north", "N")], "id long, region_name string, big_region string"))
    jobs.build_dims()
    return jobs


def orders(jobs, name="ods.order_info"):
    rows = jobs.lake.stored(name).select("id", "user_id", "dt", "total_amount").collect()
    return sorted((r.id, r.user_id, r.dt, str(r.total_amount)) for r in rows)


def test_cdc_upsert_batches_deletes_late_records_and_moves(jobs, tmp_path):
    src = tmp_path / "order_info"
    a, b, c = order(1), order(2, amount="20.00"), order(3)
    put(src, 1, [change("r", 1, None, a), change("c", 2, None, b), change("c", 3, None, c), "not json", {"op": "x"}])
    put(src, 2, [change("u", 5, order(1, amount="11.00"), order(1, amount="12.00")), change("u", 4, a, order(1, amount="11.00"))])
    put(src, 3, [change("d", 7, b), change("u", 6, b, order(2, amount="99.00"))])  # delete is newer than the update
    put(src, 4, [change("u", 2, a, order(1, amount="5.00"))])  # older than what is stored
    put(src, 5, [change("u", 8, c, order(3, day="2024-01-05"))])  # moves to another day
    put(src, 6, [change("c", 9, None, order(2, amount="21.00"))])  # inserted again
    await_all([jobs.ingest_changes("order_info", str(src))])
    assert orders(jobs) == [
        (1, 1, "2024-01-01", "12.00"),
        (2, 1, "2024-01-01", "21.00"),
        (3, 1, "2024-01-05", "10.00"),
    ]


def test_restart_goes_on_and_repeats_nothing(jobs, spark, tmp_path):
    src = tmp_path / "order_info"
    put(src, 1, [change("c", 1, None, order(1))])
    await_all([jobs.ingest_changes("order_info", str(src))])
    put(src, 2, [change("c", 2, None, order(2))])
    again = Jobs(Lake(spark, jobs.lake.root), jobs.trigger)
    await_all([again.ingest_changes("order_info", str(src))])
    await_all([again.ingest_changes("order_info", str(src))])
    assert [o[0] for o in orders(jobs)] == [1, 2]


def test_repeated_batch_and_interrupted_publish(jobs, spark):
    from shoplake.operators.sinks import append_log, log_changes, upsert_partitioned

    lake = jobs.lake
    row = "id long, v string, dt string, _op string, _ts long, _seq long"
    first = spark.createDataFrame([(1, "a", "2024-01-01", "U", 1, 1), (2, "b", None, "U", 1, 2)], row)
    second = spark.createDataFrame([(1, "c", "2024-01-01", "U", 2, 1), (2, "d", None, "U", 2, 2)], row)
    path = lake.path("ods.order_info")
    upsert_partitioned(first, path, keys=["id", "dt"], batch_id=0)
    for _ in range(2):
        upsert_partitioned(second, path, keys=["id", "dt"], batch_id=1)
    # A driver that died while publishing leaves a complete staging directory and a hole in the table.
    part = next(d for d in files.subdirectories(spark, path) if d == "dt=2024-01-01")
    files.move(spark, f"{path}/{part}", f"{path}/_staging/2/{part}")
    Path(f"{path}/_staging/2/_SUCCESS").touch()
    # One that died while staging leaves an incomplete one.
    files.make(spark, f"{path}/_staging/3/dt=2024-01-01/bucket=0")
    upsert_partitioned(spark.createDataFrame([(3, "e", "2024-01-02", "U", 3, 1)], row), path, keys=["id", "dt"], batch_id=4)
    got = sorted((r.id, r.v) for r in lake.stored("ods.order_info").collect())
    assert got == [(1, "c"), (2, "d"), (3, "e")]

    log = spark.createDataFrame([("m1", "2024-01-01"), ("m2", "2024-01-02")], "mid string, dt string")
    for _ in range(2):
        append_log(log, lake.path("ods.log_error"), 0)
    append_log(log, lake.path("ods.log_error"), 1)
    assert lake.stored("ods.log_error").count() == 4
    log_changes(first, lake.changes("x.y"), 0)
    log_changes(second, lake.changes("x.y"), 0)
    assert spark.read.orc(lake.changes("x.y")).where("v in ('c', 'd')").count() == 0


def test_latest_start_skips_old_changes(jobs, tmp_path):
    src = tmp_path / "order_info"
    put(src, 1, [change("c", 1, None, order(1)), change("c", 500, None, order(2))])
    await_all([jobs.ingest_changes("order_info", str(src), start="latest", since_ms=1400)])
    assert [o[0] for o in orders(jobs)] == [2]
    with pytest.raises(ValueError):
        jobs.ingest_changes("order_info", str(src), start="latest")


def test_lookup_keeps_the_value_of_its_time(jobs, spark, tmp_path):
    src = tmp_path / "order_info"
    put(src, 1, [change("c", 1, None, order(1, user=1)), change("c", 2, None, order(5, user=77))])
    jobs.run_once({"order_info": str(src)}, {})
    renamed = spark.createDataFrame([(1, "anna")], "id long, nick_name string")
    jobs.load_snapshot("user_info", renamed)
    jobs.build("dim.user_info")
    put(src, 2, [change("c", 3, None, order(2, user=1))])
    jobs.run_once({"order_info": str(src)}, {})
    facts = {r.id: (r.user_nick_name, r.region_name) for r in jobs.lake.stored("dwd.order_info").collect()}
    assert facts == {1: ("ann", "north"), 2: ("anna", "north"), 5: (None, "north")}


def test_trade_user_stats_follow_corrections_and_deletes(jobs, tmp_path):
    src, pay = tmp_path / "order_info", tmp_path / "payment_info"
    payment = {"id": 1, "order_id": 1, "user_id": 1, "total_amount": "7.00", "create_time": "2024-01-01 11:00:00"}
    put(src, 1, [change("c", 1, None, order(1)), change("c", 2, None, order(2, amount="20.00")), change("c", 3, None, order(3, user=2))])
    put(pay, 1, [change("c", 1, None, payment)])
    jobs.run_once({"order_info": str(src), "payment_info": str(pay)}, {})
    put(src, 2, [change("u", 4, order(1), order(1, amount="15.00")), change("d", 5, order(3, user=2))])
    put(src, 3, [change("u", 6, order(2, amount="20.00"), order(2, user=2, amount="20.00"))])  # changes its user
    put(src, 4, [change("c", 7, None, order(9, day="2023-12-01"))])  # very late day, still counted
    jobs.run_once({"order_info": str(src), "payment_info": str(pay)}, {})
    stored = jobs.lake.stored("dws.trade_user_stats")
    inputs = [jobs._input(f"dwd.{t}") for t in ("order_info", "payment_info", "refund_info", "coupon_use")]
    batch = dws.trade_user_stats(*inputs).select(stored.columns)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, batch.collect()))
    got = {(r.user_id, str(r.dt)): (r.order_count, str(r.order_total_amount), r.payment_count) for r in stored.collect()}
    assert got == {
        (1, "2024-01-01"): (1, "15.0000", 1),
        (2, "2024-01-01"): (1, "20.0000", 0),
        (1, "2023-12-01"): (1, "10.0000", 0),
    }


def view(mid, user, page, time, **more):
    return {"mid": mid, "user_id": user, "page_id": page, "during_time": 5, "create_time": time, "action_type": "x", **more}


def test_page_stats_count_distinct_users_across_batches_and_late_rows(jobs, tmp_path):
    src = tmp_path / "log_page_view"
    put(src, 1, [view("m1", 1, "home", "2024-01-01 10:00:00"), view("m1", 1, "home", "2024-01-01 10:01:00"), "{broken"])
    put(src, 2, [view("m2", 2, "home", "2024-01-01 12:00:00"), view("m1", 1, "home", "2024-01-01 12:00:00")])
    put(src, 3, [view("m3", None, "home", "2024-01-01 09:00:00"), view("m3", 2, "home", "2023-12-31 23:00:00")])
    jobs.run_once({}, {"log_page_view": str(src)})
    rows = {str(r.dt): (r.pv, r.uv, r.total_during_time) for r in jobs.lake.stored("dws.log_page_stats").collect()}
    assert rows == {"2024-01-01": (5, 2, 25), "2023-12-31": (1, 1, 5)}
    facts = jobs.lake.stored("dwd.log_page_view")
    assert {r.user_nick_name for r in facts.collect()} == {"ann", "bob", None}
    jobs.run_once({}, {"log_page_view": str(src)})
    assert facts.count() == 6
    jobs.refresh()
    assert jobs.lake.stored("dws.daily_active_users").count() == 3
    wh = jobs.warehouse()
    wh.register_views("ads.log_traffic_overview")
    total = jobs.spark.sql("select sum(total_pv) as n from ads_log_traffic_overview").first().n
    assert total == 6


def test_status_log_is_append_only(jobs, tmp_path):
    src = tmp_path / "order_status_log"
    row = {"id": 1, "order_id": 1, "order_status": 1001, "create_time": 1704103200000}
    put(src, 1, [change("c", 1, None, row), change("u", 2, row, row)])
    jobs.run_once({"order_status_log": str(src)}, {})
    rows = jobs.lake.stored("dwd.order_status_log").collect()
    assert [(r.id, r.order_status, str(r.create_time), r.dt) for r in rows] == [(1, 1001, "2024-01-01 10:00:00", "2024-01-01")]


def test_dimension_changes_and_every_source_table_has_a_job(jobs, tmp_path):
    src = tmp_path / "sku_info"
    sku = {"id": 7, "sku_name": "cup", "spu_id": 1, "price": 9.5, "is_sale": 1}
    put(src, 1, [change("r", 1, None, sku), change("u", 2, sku, {**sku, "price": "8.25"})])
    await_all([jobs.ingest_changes("sku_info", str(src))])
    jobs.build("dim.sku_info")
    assert [(r.id, str(r.price)) for r in jobs.lake.stored("dim.sku_info").collect()] == [(7, "8.25")]
    assert len(schemas.TABLES) == 20


def test_expired_days_are_dropped(jobs, spark, tmp_path):
    from datetime import date

    src = tmp_path / "order_info"
    put(src, 1, [change("c", 1, None, order(1)), change("c", 2, None, order(2, day="2024-02-15"))])
    await_all([jobs.ingest_changes("order_info", str(src))])
    assert drop_expired(spark, jobs.lake.path("ods.order_info"), date(2024, 2, 20)) == ["dt=2024-01-01"]
    assert [o[0] for o in orders(jobs)] == [2]


def test_new_checkpoints_lose_nothing(jobs, tmp_path, spark):
    """A lake whose checkpoints are gone works everything off again and takes up what is new."""
    src = tmp_path / "order_info"
    put(src, 1, [change("c", n, None, order(n, amount=f"{n}0.00")) for n in (1, 2, 3)])
    jobs.run_once({"order_info": str(src)}, {}, ["trade_user_stats"])
    put(src, 2, [change("c", 4, None, order(4, amount="40.00"))])
    lake = Lake(spark, jobs.lake.root, buckets=99, checkpoints=str(tmp_path / "new"))
    assert lake.buckets == jobs.lake.buckets
    Jobs(lake, {"availableNow": True}, max_files=1).run_once({"order_info": str(src)}, {}, ["trade_user_stats"])
    stats = jobs.lake.stored("dws.trade_user_stats").collect()
    assert [(r.order_count, r.order_total_amount) for r in stats] == [(4, 100)]
    assert jobs.lake.stored("dwd.order_info").count() == 4


def test_a_log_refuses_a_second_stream(jobs, tmp_path, spark):
    src = tmp_path / "views"
    put(src, 1, [{"mid": "m", "user_id": 1, "page_id": "p", "create_time": "2024-01-01 10:00:00.000"}])
    jobs.run_once({}, {"log_page_view": str(src)}, [])
    other = Jobs(Lake(spark, jobs.lake.root, checkpoints=str(tmp_path / "new")), {"availableNow": True})
    with pytest.raises(Exception, match="another stream"):
        other.run_once({}, {"log_page_view": str(src)}, [])
    assert jobs.lake.stored("ods.log_page_view").count() == 1


def test_transitions_follow_the_table_not_the_source(spark):
    from shoplake.operators.changelog import apply_changes, transitions

    ddl = "id long, v int, _op string, _ts long, _seq long"
    current = spark.createDataFrame([(1, 10, "U", 5, 5), (2, 20, "U", 5, 5), (3, 30, "D", 5, 5), (4, 40, "U", 5, 5)], ddl)
    changes = [
        (1, 11, "U", 6, 6), (1, 12, "U", 7, 7), (1, 99, "B", 7, 7),  # two updates: only the last counts, images do not
        (2, 19, "U", 4, 4), (2, 20, "U", 5, 5),  # late and repeated: nothing happens
        (3, 31, "U", 6, 6), (4, 40, "D", 6, 6), (5, 50, "U", 1, 1), (6, 60, "D", 1, 1),
    ]
    rows = spark.createDataFrame(changes, ddl)
    got = sorted((r.id, r.v, r._op) for r in transitions(current, rows, ["id"]).collect())
    assert got == [(1, 10, "B"), (1, 12, "U"), (3, 31, "U"), (4, 40, "B"), (5, 50, "U")]
    before = sum(r.v for r in current.where("_op = 'U'").collect())
    after = sum(r.v for r in apply_changes(current, rows, ["id"]).where("_op = 'U'").collect())
    assert before + sum(v if op == "U" else -v for _, v, op in got) == after


def test_repeated_batches_are_added_once(spark):
    from shoplake.operators.deltas import folded

    def fold(current, rows, batch):
        deltas = spark.createDataFrame(rows, "k string, n long, m long")
        return folded(current, deltas, ["k"], ["n", "m"], batch).cache()

    first = fold(None, [("a", 2, 5), ("b", 1, 1)], 0)
    second = fold(first, [("a", 1, 1), ("b", -1, -1), ("c", 1, 9)], 1)
    half = second.where("k = 'a'").unionByName(first.where("k = 'b'"))  # a run that died between two partitions
    want = [("a", 3, 6, 2, 1), ("b", 0, 0, 1, 1), ("c", 1, 9, 0, 1)]
    for state in (second, fold(second, [("a", 1, 1), ("b", -1, -1), ("c", 1, 9)], 1), fold(half, [("a", 1, 1), ("b", -1, -1), ("c", 1, 9)], 1)):
        assert sorted(tuple(r) for r in state.select("k", "n", "m", "_before", "_batch").collect()) == want
    third = fold(second, [("a", -3, -6)], 2)
    assert sorted(tuple(r) for r in third.select("k", "n", "_before").collect()) == [("a", 0, 3), ("c", 1, 0)]


def test_distinct_counts_and_attributes_go_down(spark, jobs, tmp_path):
    """The state of an aggregate with a distinct count, fed with signed rows."""
    from shoplake.operators import deltas

    stats = dws.STATS["log_page_stats"]

    def batch(number, rows):
        views = spark.createDataFrame(rows, "page_id string, dt string, page_name string, user_id long, during_time int, jump_count int, _s int")
        jobs._add("dws.test", stats, deltas.signed(views, stats, "log_page_view", views["_s"]), f"s.{number}")
        stored = jobs.lake.stored("dws.test")
        return {r.page_id: (r.page_name, r.pv, r.uv, r.total_during_time) for r in stored.collect()}

    one = [("p", "2024-01-01", n, u, 5, 0, 1) for n, u in (("old", 1), ("old", 1), ("new", 2), (None, None))]
    assert batch(0, one) == {"p": ("old", 4, 2, 20)}
    two = [("p", "2024-01-01", "old", 1, 5, 0, -1), ("q", "2024-01-01", None, 1, 1, 0, 1)]
    for _ in range(2):  # the second time is a repetition
        assert batch(1, two) == {"p": ("old", 3, 2, 15), "q": (None, 1, 1, 1)}
    three = [("p", "2024-01-01", "old", 1, 5, 0, -1), ("q", "2024-01-01", None, 1, 1, 0, -1)]
    assert batch(2, three) == {"p": ("new", 2, 1, 10)}


def test_aggregates_read_their_state_only(jobs, tmp_path):
    """Facts may vanish once their changes are added."""
    src = tmp_path / "order_info"
    put(src, 1, [change("c", 1, None, order(1)), change("c", 2, None, order(2, user=2))])
    jobs.run_once({"order_info": str(src)}, {}, ["trade_user_stats"])
    put(src, 2, [change("c", 3, None, order(3))])
    await_all([jobs.ingest_changes("order_info", str(src))])
    await_all([jobs.enrich("order_info")])
    files.remove(jobs.spark, jobs.lake.path("dwd.order_info"))
    await_all([jobs.aggregate("trade_user_stats")])
    got = {r.user_id: r.order_count for r in jobs.lake.stored("dws.trade_user_stats").collect()}
    assert got == {1: 2, 2: 1}


def test_dimensions_follow_every_table_they_name(jobs, spark, tmp_path):
    src = {t: tmp_path / t for t in ("base_brand", "base_category", "spu_info", "sku_info")}
    brand = {"id": 1, "brand_name": "acme"}
    tree = [{"id": 1, "category_name": "top", "parent_id": None}, {"id": 2, "category_name": "mid", "parent_id": 1},
            {"id": 3, "category_name": "leaf", "parent_id": 2}, {"id": 4, "category_name": "other", "parent_id": None}]
    spu = {"id": 10, "spu_name": "cup", "brand_id": 1, "category3_id": 3}
    skus = [{"id": n, "sku_name": f"s{n}", "spu_id": 10, "brand_id": 1, "category3_id": 3} for n in (100, 101)]
    put(src["base_brand"], 1, [change("c", 1, None, brand)])
    put(src["base_category"], 1, [change("c", n, None, c) for n, c in enumerate(tree)])
    put(src["spu_info"], 1, [change("c", 1, None, spu)])
    put(src["sku_info"], 1, [change("c", n, None, k) for n, k in enumerate(skus)] + [change("c", 9, None, {"id": 102, "sku_name": "lone"})])
    changes = {t: str(p) for t, p in src.items()}
    jobs.run_once(changes, {}, [])

    def dims():
        rows = jobs.lake.stored("dim.sku_info").collect()
        return {r.id: (r.sku_name, r.spu_name, r.brand_name, r.category1_name, r.category3_name) for r in rows}

    whole = ("cup", "acme", "top", "leaf")
    assert dims() == {100: ("s100", *whole), 101: ("s101", *whole), 102: ("lone", None, None, None, None)}
    put(src["base_brand"], 2, [change("u", 20, brand, {**brand, "brand_name": "emca"})])
    put(src["base_category"], 2, [change("u", 21, tree[0], {**tree[0], "category_name": "TOP"})])
    jobs.run_once({t: changes[t] for t in ("base_brand", "base_category")}, {}, [])
    whole = ("cup", "emca", "TOP", "leaf")
    assert dims() == {100: ("s100", *whole), 101: ("s101", *whole), 102: ("lone", None, None, None, None)}
    spus = jobs.lake.stored("dim.spu_info").collect()
    assert [(r.brand_name, r.category1_name) for r in spus] == [("emca", "TOP")]
    assert {r.category1_name for r in jobs.lake.stored("dim.base_category").where("id < 4 and id > 1").collect()} == {None, "TOP"}
    put(src["base_brand"], 3, [change("d", 30, {**brand, "brand_name": "emca"})])
    put(src["sku_info"], 2, [change("d", 31, skus[1])])
    put(src["spu_info"], 2, [change("u", 32, spu, {**spu, "spu_name": "mug"})])
    versions = files.subdirectories(spark, jobs.lake.path("dim.base_category"))
    jobs.run_once({t: changes[t] for t in ("base_brand", "sku_info", "spu_info")}, {}, [])
    assert dims() == {100: ("s100", "mug", None, "TOP", "leaf"), 102: ("lone", None, None, None, None)}
    assert files.subdirectories(spark, jobs.lake.path("dim.base_category")) == versions  # nothing reached it
    inputs = [jobs._input(i) for i in ("ods.sku_info", "ods.spu_info", "ods.base_brand", "dim.base_category")]
    from shoplake.plans import dim

    stored = jobs.lake.stored("dim.sku_info")
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, dim.sku_info(*inputs).select(stored.columns).collect()))


def placed(op, file, pos, before=None, after=None, row=0):
    source = {"file": f"log-bin.{file:06d}", "pos": pos, "row": row, "ts_ms": 5}
    return {"op": op, "ts_ms": 9999 - pos, "source": source, "before": before, "after": after}


def test_snapshot_hands_over_to_the_log(jobs, spark, tmp_path):
    src = tmp_path / "order_info"
    ddl = "id long, user_id long, total_amount string, create_time string"
    day = "2024-01-01 10:00:00"
    snapshot = spark.createDataFrame([(1, 1, "11.00", day), (2, 1, "20.00", day)], ddl)
    put(src, 1, [
        placed("c", 1, 900, None, order(1)), placed("c", 1, 950, None, order(7)),  # 7 was deleted where the log is lost
        placed("u", 2, 4, order(1), order(1, amount="11.00")),
        placed("u", 2, 10, order(1, amount="11.00"), order(1, amount="12.00")),  # after the snapshot
        placed("u", 2, 10, order(2, amount="20.00"), order(2, amount="21.00"), row=1),
        placed("u", 10, 2, order(2, amount="21.00"), order(2, amount="22.00")),  # file 10 is later than 2
        placed("c", 2, 11, None, order(3)),
    ])
    jobs.load_snapshot("order_info", snapshot, position=(2, 4))
    await_all([jobs.ingest_changes("order_info", str(src))])
    assert [(i, a) for i, _, _, a in orders(jobs)] == [(1, "12.00"), (2, "22.00"), (3, "10.00")]
    again = spark.createDataFrame([(2, 1, "23.00", day), (3, 1, "10.00", day)], ddl)
    jobs.load_snapshot("order_info", again, position=(10, 7))  # 1 is gone
    put(src, 2, [placed("u", 10, 6, order(2), order(2, amount="0.00")), placed("c", 10, 8, None, order(4))])
    await_all([jobs.ingest_changes("order_info", str(src))])
    assert [(i, a) for i, _, _, a in orders(jobs)] == [(2, "23.00"), (3, "10.00"), (4, "10.00")]
    with pytest.raises(ValueError, match="position"):
        jobs.ingest_changes("user_info", str(src))


def test_repeated_append_writes_only_missing_days(jobs, spark):
    from shoplake.operators.sinks import append_log

    path = jobs.lake.path("ods.log_error")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)], "mid string, dt string")
    append_log(rows, path, "s.0")
    files.remove(spark, f"{path}/day=2024-01-02/batch=s.0")  # as if the first run had not come so far
    kept = {p.name: p.stat().st_mtime_ns for p in Path(path).rglob("*.orc")}
    append_log(rows, path, "s.0")
    assert sorted(r.mid for r in jobs.lake.stored("ods.log_error").collect()) == ["a", "b", "c"]
    now = {p.name: p.stat().st_mtime_ns for p in Path(path).rglob("*.orc")}
    assert kept.items() <= now.items()
    append_log(rows, path, "s.1")
    assert jobs.lake.stored("ods.log_error").count() == 6
    assert files.subdirectories(spark, f"{path}/_begun") == ["s.1"]


def error(mid, time="2024-01-01 10:00:00", **more):
    return {"mid": mid, "user_id": 1, "err_code": "E1", "create_time": time, **more}


def test_few_bad_rows_are_set_aside_many_stop_the_stream(jobs, spark, tmp_path):
    src = tmp_path / "log_error"
    good = [error(f"m{n}") for n in range(18)]
    put(src, 1, [*good, '{"mid": "cut', {**error("x"), "user_id": "nobody"}])
    await_all([jobs.ingest_log("log_error", str(src), bad_rows=0.1)])
    assert jobs.lake.stored("ods.log_error").count() == 18
    aside = {(r.mid, r.user_id, tuple(r._bad)) for r in jobs.quarantined("log_error").collect()}
    assert aside == {(None, None, ("no JSON object",)), ("x", None, ("bad user_id",))}
    put(src, 2, [*good[:17], '{"mid": "cut', error("y", time="then"), error("z", time=None)])
    with pytest.raises(Exception, match="3 of 20 rows"):
        await_all([jobs.ingest_log("log_error", str(src), bad_rows=0.1)])
    assert jobs.lake.stored("ods.log_error").count() == 18
    assert {r._bad[0] for r in jobs.quarantined("log_error").where("mid in ('y', 'z')").collect()} == {"bad create_time", "no create_time"}
    await_all([jobs.ingest_log("log_error", str(src), bad_rows=0.5)])  # the same batch, by a wider gate
    assert jobs.lake.stored("ods.log_error").count() == 35
    assert jobs.quarantined("log_error").count() == 5


def test_sums_that_do_not_fit_are_set_aside(jobs, spark):
    from shoplake.operators import deltas
    from shoplake.operators.gate import TooManyBadRows

    stats = dws.STATS["trade_user_stats"]

    def add(number, users):
        ddl = "user_id long, dt string, user_nick_name string, user_level tinyint, age_range string, gender tinyint, total_amount decimal(18,2), original_total_amount decimal(18,2), coupon_reduce_amount decimal(18,2)"
        rows = [(u, "2024-01-01", "n", None, None, None, a, None, None) for u, a in users]
        orders = spark.createDataFrame(rows, ddl)
        from pyspark.sql import functions as F

        jobs._add("dws.trade_user_stats", stats, deltas.signed(orders, stats, "order_info", F.lit(1)), f"s.{number}")

    from decimal import Decimal

    most = Decimal("99999999999999.00")
    add(0, [(u, Decimal("1.00")) for u in range(12)] + [(99, most)])
    add(1, [(u, Decimal("1.00")) for u in range(12)] + [(99, most)])
    stored = {r.user_id: r.order_total_amount for r in jobs.lake.stored("dws.trade_user_stats").collect()}
    assert stored[99] == most and set(stored[u] for u in range(12)) == {2}  # the group keeps what it had
    assert [(r.user_id, r._bad) for r in jobs.quarantined("trade_user_stats").collect()] == [(99, ["order_total_amount too large"])]
    with pytest.raises(TooManyBadRows):
        add(2, [(99, most)])


def test_watermark_notes_late_rows_and_restarts_with_its_mark(jobs, spark, tmp_path):
    from shoplake.operators.lateness import Watermark

    src = tmp_path / "log_error"
    put(src, 1, [error("a", "2024-01-02 10:00:00"), error("b", "2024-01-02 09:00:00"), error("n", None)])
    await_all([jobs.ingest_log("log_error", str(src), Watermark("30 minutes", drop=True))])
    put(src, 2, [error("c", "2024-01-02 09:29:59"), error("d", "2024-01-02 09:30:00"), error("m", None)])
    put(src, 3, [error("e", "2024-01-01 00:00:00")])
    again = Jobs(jobs.lake, jobs.trigger, max_files=1)
    await_all([again.ingest_log("log_error", str(src), Watermark("30 minutes", drop=True))])
    assert sorted(r.mid for r in jobs.lake.stored("ods.log_error").collect()) == ["a", "b", "d", "m", "n"]
    late, counts = jobs.late("log_error")
    assert sorted(r.mid for r in late.collect()) == ["c", "e"]
    seen = sorted((r.mark or "", r.rows, r.late) for r in counts.where("rows > 0").collect())
    assert seen == [("", 3, 0), ("2024-01-02 09:30:00", 1, 1), ("2024-01-02 09:30:00", 3, 1)]


def test_refresh_takes_only_changed_days(jobs, spark, tmp_path):
    src = tmp_path / "order_info"
    rows = [order(1), order(2, day="2024-01-02"), order(3, day="2024-01-03")]
    put(src, 1, [change("c", n, None, o) for n, o in enumerate(rows)])
    jobs.run_once({"order_info": str(src)}, {}, [])
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    mvs = ("trade_region_stats", "daily_order_users")
    assert jobs.refresh_changed(mvs) == dict.fromkeys(mvs, days)
    assert jobs.refresh_changed(mvs) == {t: [] for t in mvs}

    def state(table):
        path = Path(jobs.lake.path(f"dws.{table}"))
        return {d.name: sorted((p.name, p.stat().st_mtime_ns) for p in d.glob("*.orc")) for d in path.glob("dt=*")}

    before = {t: state(t) for t in mvs}
    put(src, 2, [change("u", 10, rows[0], order(1, amount="99.00")), change("d", 11, rows[2])])
    jobs.run_once({"order_info": str(src)}, {}, [])
    assert jobs.refresh_changed(mvs) == dict.fromkeys(mvs, ["2024-01-01", "2024-01-03"])
    for table in mvs:
        after = state(table)
        assert after["dt=2024-01-02"] == before[table]["dt=2024-01-02"] and after["dt=2024-01-01"] != before[table]["dt=2024-01-01"]
        assert set(after) == {"dt=2024-01-01", "dt=2024-01-02"}  # the third day lost its last order
    amounts = {str(r.dt): str(r.order_total_amount) for r in jobs.lake.stored("dws.trade_region_stats").collect()}
    assert amounts == {"2024-01-01": "99.0000", "2024-01-02": "10.0000"}


def test_event_keys_leave_out_what_comes_again(jobs, spark, tmp_path):
    from shoplake.operators.lateness import Watermark

    src = tmp_path / "log_error"
    key = ["mid", "create_time"]
    put(src, 1, [error("a"), error("a"), error("b"), error("b", "2024-01-01 10:00:01"), error(None), error(None), error("t", None)])
    await_all([jobs.ingest_log("log_error", str(src), Watermark("1 day"), event_key=key)])
    put(src, 2, [error("b"), error("c")])
    await_all([jobs.ingest_log("log_error", str(src), Watermark("1 day"), event_key=key)])
    want = [("None", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:00:00"),
            ("b", "2024-01-01 10:00:01"), ("c", "2024-01-01 10:00:00"), ("t", "None")]

    def stored():
        return sorted((str(r.mid), str(r.create_time)) for r in jobs.lake.stored("ods.log_error").collect())

    assert stored() == want
    put(src, 3, [error("d")])
    lost = Jobs(Lake(spark, jobs.lake.root, checkpoints=str(tmp_path / "new")), {"availableNow": True}, max_files=1)
    await_all([lost.ingest_log("log_error", str(src), Watermark("1 day"), event_key=key)])
    assert stored() == sorted([*want, ("d", "2024-01-01 10:00:00")])


def test_many_users_do_not_pass_the_driver(jobs, spark):
    """The files of the users are small, but each stream of the trade facts would send all rows through the driver."""
    jobs.load_snapshot("user_info", spark.range(500_000).selectExpr("id", "'ann' as nick_name", "1 as user_level", "1 as gender"))
    jobs.build_dims()
    users = jobs._input("dim.user_info")
    for table, others in (("order_info", ["dim.base_region"]), ("payment_info", []), ("refund_info", []), ("coupon_use", ["dim.coupon_info"])):
        build, inputs = RULES[f"dwd.{table}"]
        fact = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in jobs._shape(inputs[0])))
        plan = build(fact, users, *[jobs._input(d) for d in others])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == len(others)


def test_old_images_are_not_enriched(jobs, tmp_path, monkeypatch):
    """An update's old image stays in the raw log; the fact table takes its own row instead, so nothing is looked up for it."""
    src, a, ops, fold = tmp_path / "order_info", order(1), [], Jobs._fold

    def seen(self, name, changes, n, keys):
        if name.startswith("dwd."):
            ops.extend(r._op for r in changes.select("_op").collect())
        fold(self, name, changes, n, keys)

    monkeypatch.setattr(Jobs, "_fold", seen)
    put(src, 1, [change("c", 1, None, a)])
    put(src, 2, [change("u", 2, a, order(1, amount="12.00"))])
    put(src, 3, [change("u", 3, order(1, amount="12.00"), order(1, amount="12.00", day="2024-01-02"))])
    jobs.run_once({"order_info": str(src)}, {}, ["trade_user_stats"])
    logged = [r._op for r in jobs.spark.read.orc(jobs.lake.changes("ods.order_info")).collect()]
    assert sorted(logged) == ["B", "D", "U", "U", "U"] and sorted(ops) == ["D", "U", "U", "U"]
    assert orders(jobs, "dwd.order_info") == [(1, 1, "2024-01-02", "12.00")]
    rows = jobs.lake.stored("dws.trade_user_stats").collect()
    assert [(str(r.dt), r.order_count, str(r.order_total_amount)) for r in rows] == [("2024-01-02", 1, "12.0000")]
