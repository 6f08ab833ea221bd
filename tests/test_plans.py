"""What the plans look like, and that the plans for large inputs give the same rows."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import rows_of
from shoplake.operators import lookup_join, ranking, sizing
from shoplake.plans import Warehouse

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "key",
    [
        "dwd_log_action",
        "dwd_order_info",
        "dws_trade_user_stats",
        "ads_user_trade_ranking",
        "ads_log_page_ranking",
        "ads_page_transition_matrix",
    ],
)
def test_plans_for_large_inputs_give_the_same_rows(spark, monkeypatch, key):
    monkeypatch.setattr(sizing, "fits", lambda df, limit: False)
    df = entry.queries()[key](spark, SF)
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    answer = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in answer.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, answer.fetchall())


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["dws_log_page_stats"](spark, SF))
    scan = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "EqualTo(event_type,view)" in scan
    assert "event_id" not in scan.split("ReadSchema:")[1]
    plan = plan_of(entry.queries()["dws_trade_region_stats"](spark, SF))
    scan = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "o_orderpriority" not in scan and "o_orderdate" not in scan


def test_large_lookup_reads_only_needed_columns(spark):
    fact = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnRenamed("l_orderkey", "id")
    dim = spark.read.parquet(f"{SF}/part.parquet")
    joined = lookup_join(fact, dim, ("l_partkey", "p_partkey"), {"name": "p_name"}, broadcast_bytes=0)
    scan = next(line for line in plan_of(joined.select("name")).splitlines() if "lineitem.parquet" in line)
    assert scan.split("ReadSchema:")[1].count(":") == 2  # the key and the row's identity


def test_hot_keys_are_split_at_run_time(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        fact = spark.range(0, 60_000, numPartitions=6).select("id", hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(0, 5_000, numPartitions=4).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("v"))
        joined = lookup_join(fact, dim, ("k", "k"), {"v": "v"}, broadcast_bytes=0)
        found = joined.agg(F.count_if(F.col("v") == "n7").alias("hot"), F.count("v").alias("n"), F.max("pad"))
        assert tuple(found.first()[:2]) == (20_001, 20_000 + 5_000 - 1_667)
        found.collect()
        assert "skew=true" in plan_of(found)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_large_ranking_has_no_window_over_a_whole_day(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderdate", "o_orderkey", "o_totalprice")
    ranked = ranking.rank_by(df, ["o_orderdate"], {"rn": "o_totalprice"}, ["o_orderkey"], single_group_bytes=0)
    top = ranked._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(line for line in top if "row_number()" in line)
    assert "_range" in window.split("windowspecdefinition")[1]


def test_no_python_in_any_plan(spark):
    for key, query in entry.queries().items():
        if key.startswith(("ads_", "rpt_")):
            assert "Python" not in query(spark, SF)._jdf.queryExecution().optimizedPlan().toString(), key


@pytest.mark.parametrize(
    "key",
    [
        "dws_page_transition_stats",
        "dws_log_page_stats",
        "dws_daily_active_users",
        "dws_daily_order_users",
        "dws_gmv_hourly_trend",
        "dws_log_error_stats",
        "ads_log_funnel_analysis",
        "ads_user_browse_retention",
    ],
)
def test_no_lookup_of_columns_that_nothing_uses(spark, key):
    plan = entry.queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan


@pytest.mark.parametrize("key", ["ads_daily_trade_overview", "ads_gmv_realtime_dashboard", "ads_gmv_today_summary"])
def test_unused_attributes_are_not_looked_up(spark, key):
    plan = plan_of(entry.queries()[key](spark, SF))
    # Users are read for the orders' own columns alone.
    scans = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "customer.parquet" in line and "ReadSchema:" in line]
    assert scans and not any("c_name" in scan for scan in scans)
    assert "_dim_" not in plan


def test_attributes_are_looked_up_for_groups(spark):
    for key, column in (("dws_trade_sku_stats", "brand_name"), ("dws_trade_user_stats", "user_nick_name")):
        plan = entry.queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        lookup = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
        assert lookup < next(i for i, line in enumerate(lines) if "Aggregate" in line)
        assert column in lines[0]


def test_stored_facts_keep_their_own_attributes(spark):
    """One stored fact is enough: what it says about a user is not looked up anew."""
    whole = entry.warehouse(spark, SF)
    then = whole["dwd.order_info"].withColumn("user_nick_name", F.concat(F.lit("~"), "user_nick_name"))

    def stored(name):
        return then if name == "dwd.order_info" else whole[name] if name.startswith("raw.") else None

    mixed = Warehouse(stored, as_of=entry.AS_OF, today=entry.TODAY)
    names = mixed["dws.trade_user_stats"].where("order_count > 0").select("user_nick_name").distinct().collect()
    assert names and all(r.user_nick_name.startswith("~") for r in names)
    regions = mixed["dws.trade_region_stats"]
    assert regions.columns == whole["dws.trade_region_stats"].columns


def test_views_that_use_an_attribute_keep_it(spark):
    whole = entry.warehouse(spark, SF)
    rows = whole["ads.user_trade_ranking"].where("user_nick_name is not null").limit(1).collect()
    assert rows and whole["rpt.big_region_amount"].where("big_region is not null").limit(1).collect()
    exposed = whole["ads.log_sku_exposure_ranking"]
    assert {"sku_name", "brand_name"} <= set(exposed.columns)


def test_large_ranking_computes_its_input_once(spark):
    """Two ranks of an aggregate: counts and numbers come from the same shuffle, so the files are read once."""
    df = spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_orderdate", "o_custkey").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = ranking.rank_by(df, ["o_orderdate"], {"rn": "total", "rc": "n"}, ["o_custkey"], single_group_bytes=0)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
