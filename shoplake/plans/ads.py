"""Report views.  Each takes aggregates (or other views) and stays lazy.

Rows come in no particular order; the reports sort.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import mean, pct, ratio
from shoplake.operators import (
    funnel,
    growth_vs_prev,
    rank_by,
    retention,
    rfm,
    running_sum,
    share_of_total,
    top_by,
    trailing_mean,
)


def _sums(*cols: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in cols]


# --- trade -----------------------------------------------------------------


def _daily_totals(trade_user_stats: DataFrame, amount_name: str) -> DataFrame:
    names = {
        "order_count": "total_order_count",
        "order_total_amount": amount_name,
        "order_original_amount": "total_original_amount",
        "order_coupon_reduce": "total_coupon_reduce",
        "payment_count": "total_payment_count",
        "payment_total_amount": "total_payment_amount",
        "refund_count": "total_refund_count",
        "refund_total_amount": "total_refund_amount",
        "coupon_count": "total_coupon_count",
        "coupon_reduce_amount": "total_coupon_reduce_amount",
    }
    return trade_user_stats.groupBy("dt").agg(*[F.sum(c).alias(out) for c, out in names.items()])


def daily_trade_overview(trade_user_stats: DataFrame) -> DataFrame:
    return _daily_totals(trade_user_stats, "total_order_amount")


def user_trade_ranking(trade_user_stats: DataFrame) -> DataFrame:
    rows = trade_user_stats.select(
        "dt", "user_id", "user_nick_name", "user_level", "order_count", "order_total_amount",
        "payment_total_amount", "refund_total_amount",
    )
    ranks = {"rn_order": "order_total_amount", "rn_payment": "payment_total_amount"}
    return rank_by(rows, ["dt"], ranks, ["user_id"])


_SKU_SALES = (
    "dt", "sku_id", "sku_name", "spu_name", "category3_name", "category2_name", "category1_name", "brand_name",
    "order_count", "order_sku_num", "order_total_amount", "cart_count",
)


def sku_sales_ranking(trade_sku_stats: DataFrame) -> DataFrame:
    ranks = {"rn_amount": "order_total_amount", "rn_qty": "order_sku_num"}
    return rank_by(trade_sku_stats.select(*_SKU_SALES), ["dt"], ranks, ["sku_id"])


def region_trade_overview(trade_region_stats: DataFrame) -> DataFrame:
    rows = trade_region_stats.select(
        "dt", "province_id", "region_name", "big_region", "order_count", "order_total_amount",
        "order_original_amount", "order_coupon_reduce",
    )
    return rank_by(rows, ["dt"], {"rn": "order_total_amount"}, ["province_id"])


def coupon_analysis(trade_coupon_stats: DataFrame) -> DataFrame:
    return trade_coupon_stats.select(
        "dt", "coupon_id", "coupon_name", "coupon_type", "full_amount", "reduce_amount", "use_condition",
        "coupon_count", "coupon_reduce_amount",
    )


# A sku has one row per day in trade_sku_stats, so counting rows counts distinct skus.
def category1_sales_summary(trade_sku_stats: DataFrame) -> DataFrame:
    return trade_sku_stats.groupBy("dt", "category1_id", "category1_name").agg(
        F.count("sku_id").alias("sku_count"),
        *_sums(
            "order_count", "order_sku_num", "order_total_amount", "order_coupon_reduce",
            "order_activity_reduce", "cart_count", "cart_sku_num",
        ),
    )


def brand_sales_summary(trade_sku_stats: DataFrame) -> DataFrame:
    return trade_sku_stats.groupBy("dt", "brand_id", "brand_name").agg(
        F.count("sku_id").alias("sku_count"),
        *_sums("order_count", "order_sku_num", "order_total_amount", "cart_count"),
    )


# --- logs ------------------------------------------------------------------


def log_traffic_overview(log_page_stats: DataFrame) -> DataFrame:
    """``total_uv`` adds up the pages' visitors: a visitor counts once per page."""
    totals = log_page_stats.groupBy("dt").agg(
        F.sum("pv").alias("total_pv"),
        F.sum("uv").alias("total_uv"),
        F.sum("total_during_time").alias("total_during_time"),
        F.sum("total_jump_count").alias("total_jump_count"),
    )
    return totals.withColumn("avg_during_time", mean(F.col("total_during_time"), F.col("total_pv")))


def log_page_ranking(log_page_stats: DataFrame) -> DataFrame:
    rows = log_page_stats.select(
        "dt", "page_id", "page_name", "pv", "uv", "total_during_time",
        mean(F.col("total_during_time"), F.col("pv")).alias("avg_during_time"),
    )
    return rank_by(rows, ["dt"], {"rn_pv": "pv", "rn_uv": "uv"}, ["page_id"])


def log_sku_exposure_ranking(log_sku_exposure_stats: DataFrame) -> DataFrame:
    ranks = {"rn_exposure": "exposure_count", "rn_exposure_user": "exposure_user_count"}
    return rank_by(log_sku_exposure_stats, ["dt"], ranks, ["sku_id"])


def log_user_activity_ranking(log_user_action_stats: DataFrame) -> DataFrame:
    """Errors are shown but not part of the total."""
    total = F.col("startup_count") + F.col("page_view_count") + F.col("action_count") + F.col("exposure_count")
    rows = log_user_action_stats.select(
        "dt", "user_id", "user_nick_name", "user_level", "startup_count", "page_view_count", "action_count",
        "exposure_count", "error_count", total.alias("total_action_count"),
    )
    return rank_by(rows, ["dt"], {"rn": "total_action_count"}, ["user_id"])


def log_error_analysis(log_error_stats: DataFrame) -> DataFrame:
    return log_error_stats.select("dt", "err_code", "err_name", "error_count", "error_user_count", "error_device_count")


def log_funnel_analysis(
    log_page_view: DataFrame, log_action: DataFrame, cart_info: DataFrame, order_info: DataFrame
) -> DataFrame:
    """Users per day: sku pages seen, sku actions, carts, orders."""
    stages = [
        ("browse", log_page_view.where(F.col("page_id").startswith("sku"))),
        ("action", log_action.where("item_type = 'sku'")),
        ("cart", cart_info),
        ("order", order_info),
    ]
    return funnel(stages)


# --- retention and paths -----------------------------------------------------


def user_first_active(daily_active_users: DataFrame) -> DataFrame:
    return daily_active_users.groupBy("user_id").agg(F.min("dt").alias("first_active_dt"))


def user_first_order(daily_order_users: DataFrame) -> DataFrame:
    return daily_order_users.groupBy("user_id").agg(F.min("dt").alias("first_order_dt"))


def user_browse_retention(daily_active_users: DataFrame) -> DataFrame:
    return retention(daily_active_users, "new_users", "day{}_retained", "day{}_retention_rate")


def user_purchase_retention(daily_order_users: DataFrame) -> DataFrame:
    return retention(daily_order_users, "new_buyers", "day{}_repurchase", "day{}_repurchase_rate")


def _transitions(page_transition_stats: DataFrame, *more: str) -> DataFrame:
    return page_transition_stats.select(
        "dt", F.col("last_page_id").alias("from_page"), F.col("page_id").alias("to_page"), "transition_count",
        "transition_users", *more,
    )


def page_transition_matrix(page_transition_stats: DataFrame) -> DataFrame:
    rows = _transitions(page_transition_stats, "transition_sessions")
    no_next = F.col("to_page").isNull() | (F.col("to_page") == "")
    rows = rows.withColumn("is_bounce", F.when(no_next, 1).otherwise(0))
    return rank_by(rows, ["dt"], {"rn": "transition_count"}, ["from_page", "to_page"])


def user_path_top10(page_transition_stats: DataFrame) -> DataFrame:
    top = top_by(_transitions(page_transition_stats), ["dt"], "transition_count", ["from_page", "to_page"], 10)
    path = F.concat("from_page", F.lit(" -> "), "to_page").alias("path")
    return top.select("dt", path, "transition_count", "transition_users", "rn")


def page_outflow_top3(page_transition_stats: DataFrame) -> DataFrame:
    return top_by(_transitions(page_transition_stats), ["dt", "from_page"], "transition_count", ["to_page"], 3)


# --- customer value --------------------------------------------------------


def rfm_user_segmentation(trade_user_stats: DataFrame, as_of: date | Column) -> DataFrame:
    return rfm(trade_user_stats, as_of)


def rfm_segment_summary(rfm_user_segmentation: DataFrame) -> DataFrame:
    users = F.count(F.lit(1))
    groups = rfm_user_segmentation.groupBy("user_segment").agg(
        users.alias("user_count"),
        F.sum("frequency").alias("total_orders"),
        F.sum("monetary").alias("total_amount"),
        ratio(F.sum("recency"), F.count("recency"), 1).alias("avg_recency"),
        ratio(F.sum("frequency"), F.count("frequency"), 1).alias("avg_frequency"),
        ratio(F.sum("monetary"), F.count("monetary"), 2).alias("avg_monetary"),
    )
    # Eight rows at most, so the shares over all of them are cheap.
    return groups.withColumn("user_pct", share_of_total(F.col("user_count"))).withColumn(
        "amount_pct", share_of_total(F.col("total_amount"))
    )


# --- GMV -------------------------------------------------------------------


def gmv_realtime_dashboard(trade_user_stats: DataFrame) -> DataFrame:
    totals = _daily_totals(trade_user_stats, "total_gmv")
    orders = F.col("total_order_count")
    return totals.select(
        "*",
        pct(F.col("total_payment_count"), orders).alias("payment_conversion_rate"),
        pct(F.col("total_refund_count"), orders).alias("refund_rate"),
        mean(F.col("total_gmv"), orders, 2).alias("avg_order_amount"),
        pct(F.col("total_coupon_reduce"), F.col("total_original_amount")).alias("coupon_usage_rate"),
    )


def gmv_hourly_trend(gmv_hourly: DataFrame) -> DataFrame:
    gmv = F.col("gmv")
    return gmv_hourly.select(
        "*",
        growth_vs_prev(gmv, ["dt"], "hour").alias("gmv_hourly_growth_rate"),
        running_sum(gmv, ["dt"], "hour").alias("cumulative_gmv"),
    )


def gmv_today_summary(gmv_realtime_dashboard: DataFrame, today: date | Column) -> DataFrame:
    day = (today if isinstance(today, Column) else F.lit(today)).cast("date")
    return gmv_realtime_dashboard.where(F.col("dt") == day).select(
        "dt", "total_order_count", "total_gmv", "total_payment_amount", "total_refund_amount",
        "payment_conversion_rate", "refund_rate", "avg_order_amount", "coupon_usage_rate",
    )


# --- sales trends ------------------------------------------------------------


def sku_sales_trend(trade_sku_stats: DataFrame) -> DataFrame:
    """Means over a sku's last 7 rows and growth against its previous row."""

    def week(col: str, scale: int) -> Column:
        return trailing_mean(F.col(col), ["sku_id"], "dt", 7, scale)

    return trade_sku_stats.select(
        "dt", "sku_id", "sku_name", "spu_name", "category1_name", "brand_name", "order_count", "order_sku_num",
        "order_total_amount", "cart_count",
        week("order_count", 1).alias("avg_7d_order_count"),
        week("order_total_amount", 2).alias("avg_7d_amount"),
        week("cart_count", 1).alias("avg_7d_cart_count"),
        growth_vs_prev(F.col("order_count"), ["sku_id"], "dt").alias("daily_growth_rate"),
    )


# Anomaly names.
SURGE, DROP, BURST, NORMAL = "销量激增", "销量下滑", "新品爆发", "正常"


def sku_sales_anomaly(sku_sales_trend: DataFrame) -> DataFrame:
    """Days more than 30 % above or below the 7-row mean.

    The filter keeps only surges and drops; the other two names complete the
    labelling for callers who reuse it on unfiltered rows.
    """
    count, week = F.col("order_count"), F.col("avg_7d_order_count")
    high, low = count > week * 1.3, count < week * 0.7
    label = (
        F.when((week > 0) & high, SURGE)
        .when((week > 0) & low, DROP)
        .when((week == 0) & (count > 0), BURST)
        .otherwise(NORMAL)
    )
    # The mean has one decimal; as a decimal the difference stays exact.
    exact = week.cast("decimal(20,1)")
    return sku_sales_trend.where((week > 0) & (high | low)).select(
        "dt", "sku_id", "sku_name", "spu_name", "category1_name", "brand_name", "order_count",
        "avg_7d_order_count", "order_total_amount", "avg_7d_amount",
        pct(count - exact, exact).alias("deviation_rate"),
        label.alias("anomaly_type"),
    )


def category_sales_trend(trade_sku_stats: DataFrame) -> DataFrame:
    days = trade_sku_stats.groupBy("dt", "category1_name").agg(
        F.sum("order_count").alias("total_order_count"),
        F.sum("order_sku_num").alias("total_sku_num"),
        F.sum("order_total_amount").alias("total_amount"),
        F.sum("cart_count").alias("total_cart_count"),
    )
    amount = F.col("total_amount")
    return days.select(
        "*",
        trailing_mean(F.col("total_order_count"), ["category1_name"], "dt", 7, 1).alias("avg_7d_order_count"),
        trailing_mean(amount, ["category1_name"], "dt", 7, 2).alias("avg_7d_amount"),
        share_of_total(amount, ["dt"]).alias("amount_pct"),
    )
