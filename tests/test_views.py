"""Views and reports on hand-made aggregates."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from shoplake.plans import ads, dwd, reports

SKU = (
    "sku_id long, dt date, sku_name string, spu_id long, spu_name string, category3_id long, category3_name string, "
    "category2_id long, category2_name string, category1_id long, category1_name string, brand_id long, "
    "brand_name string, order_count long, order_sku_num long, order_total_amount decimal(18,4), "
    "order_coupon_reduce decimal(18,4), order_activity_reduce decimal(18,4), cart_count long, cart_sku_num long"
)


def sku_days(spark, counts, sku=1, start=1, step=1):
    rows = []
    for i, n in enumerate(counts):
        day = date.fromordinal(date(2024, 1, start).toordinal() + i * step)
        rows.append((sku, day, "s", 1, "p", 3, "c3", 2, "c2", 1, "c1", 1, "b", n, n, Decimal(n), Decimal(0), Decimal(0), n, n))
    return spark.createDataFrame(rows, SKU)


def test_trend_uses_rows_not_calendar_days(spark):
    counts = [1, 2, 0, 4, 5, 6, 7, 8]
    got = ads.sku_sales_trend(sku_days(spark, counts, step=3)).orderBy("dt").collect()
    means = [1.0, 1.5, 1.0, 1.8, 2.4, 3.0, 3.6, 4.6]
    assert [r.avg_7d_order_count for r in got] == means
    assert [r.daily_growth_rate for r in got] == [0.0, 100.0, -100.0, 0.0, 25.0, 20.0, 16.67, 14.29]


def test_anomalies_are_surges_and_drops_only(spark):
    got = ads.sku_sales_anomaly(ads.sku_sales_trend(sku_days(spark, [10, 10, 30, 1, 0, 10])))
    rows = [(r.order_count, r.anomaly_type) for r in got.orderBy("dt").collect()]
    assert rows == [(30, ads.SURGE), (1, ads.DROP), (0, ads.DROP)]


def test_category_share_of_a_day_without_sales_is_null(spark):
    got = ads.category_sales_trend(sku_days(spark, [0, 5])).orderBy("dt").collect()
    assert [r.amount_pct for r in got] == [None, 100.0]


def test_brand_region_pairs_equal_the_full_cross(spark):
    day = date(2024, 1, 2)
    brands = spark.createDataFrame(
        [(day, i, f"b{i}", Decimal(100 - i % 4)) for i in range(30)], "dt date, brand_id long, brand_name string, order_total_amount decimal(18,4)"
    )
    regions = spark.createDataFrame(
        [(day, i, f"r{i}", Decimal(i)) for i in range(1, 4)], "dt date, province_id int, region_name string, order_total_amount decimal(18,4)"
    )
    got = [tuple(r) for r in reports.brand_region_cross(brands, regions, 20).collect()]
    pairs = brands.crossJoin(regions.select("province_id", "region_name", F.col("order_total_amount").alias("ra")))
    full = pairs.orderBy(F.desc("order_total_amount"), "brand_id", F.desc("ra"), "province_id").limit(20)
    assert got == [tuple(r) for r in full.select("brand_name", "order_total_amount", "region_name", "ra").collect()]
    alone = reports.brand_region_cross(brands, regions.where("false"), 5).collect()
    assert len(alone) == 5 and all(r.region_name is None for r in alone)


def test_action_on_a_brand_gets_no_sku(spark):
    columns = "mid string, user_id long, item_type string, item_id string, target_page_id string, create_time timestamp_ntz, dt string"
    rows = [("m", 1, "sku", "7", None, None, "d"), ("m", 1, "brand", "7", None, None, "d"), ("m", 1, "sku", "x", None, None, "d")]
    names = ["sku_name", "spu_name", "category3_name", "category2_name", "category1_name", "brand_name"]
    sku = spark.createDataFrame([(7, *names)], "id long, " + ", ".join(f"{n} string" for n in names))
    user = spark.createDataFrame([(1, "ann", 1, "18-25", 1)], "id long, nick_name string, user_level int, age_range string, gender int")
    got = dwd.log_action(spark.createDataFrame(rows, columns), user, sku).collect()
    assert {(r.item_type, r.item_id): r.sku_name for r in got} == {
        ("brand", "7"): None,
        ("sku", "7"): "sku_name",
        ("sku", "x"): None,
    }
    assert {r.user_nick_name for r in got} == {"ann"}


def test_stored_split_amounts_add_up(spark):
    """The source's own rules: line reductions add up to the order's, totals are original less coupon."""
    lines = spark.createDataFrame(
        [(1, 2, Decimal("10.00"), Decimal("1.6667"), Decimal("18.3333")), (1, 1, Decimal("5.00"), Decimal("0.3333"), Decimal("4.6667"))],
        "order_id long, sku_num int, order_price decimal(18,2), split_coupon_amount decimal(18,4), split_total_amount decimal(18,4)",
    )
    off = F.col("order_price") * F.col("sku_num") - F.col("split_coupon_amount") != F.col("split_total_amount")
    assert lines.where(off).count() == 0
    assert lines.agg(F.sum("split_coupon_amount")).first()[0] == Decimal("2.0000")
