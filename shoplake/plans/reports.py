"""Dashboard reports: sorted, limited queries over the views.

"Latest day" is the latest day with data, not today.  Reports that list the
first rows of a ranking select them with a top-k instead of ranking the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import epoch_ms
from shoplake.operators import latest_nonempty_day, top_by

# Funnel stage names.
STAGES = {"browse_users": "浏览", "action_users": "动作", "cart_users": "加购", "order_users": "下单"}


def _latest(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(F.col("dt") == latest_nonempty_day(df, cond))


def _percent(col: str) -> Column:
    return F.concat(F.format_string("%.2f", F.col(col)), F.lit("%"))


def _first(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(measure), *ties).limit(n)


_SOLD = "order_total_amount"


def trade_kpis(gmv_realtime_dashboard: DataFrame) -> DataFrame:
    """The key figures of the latest day; rates as percentage text."""
    day = _latest(gmv_realtime_dashboard, (F.col("total_gmv") > 0) | (F.col("total_order_count") > 0))
    return day.select(
        "dt", "total_gmv", "total_order_count", "total_payment_amount",
        _percent("payment_conversion_rate").alias("payment_conversion_rate"),
        "avg_order_amount",
        _percent("refund_rate").alias("refund_rate"),
        _percent("coupon_usage_rate").alias("coupon_usage_rate"),
        "total_coupon_count", "total_coupon_reduce_amount",
    )


def trade_trend(daily_trade_overview: DataFrame, days: int = 30) -> DataFrame:
    last = daily_trade_overview.orderBy(F.desc("dt")).limit(days)
    return last.select(
        epoch_ms(F.col("dt")).alias("time"), "total_order_amount", "total_payment_amount", "total_order_count",
        "total_payment_count",
    )


def daily_trade_detail(daily_trade_overview: DataFrame, days: int = 10) -> DataFrame:
    return daily_trade_overview.orderBy(F.desc("dt")).limit(days).select(
        "dt", "total_order_count", "total_order_amount", "total_payment_amount", "total_refund_amount",
        "total_coupon_reduce_amount",
    )


def brand_detail(brand_sales_summary: DataFrame) -> DataFrame:
    day = _latest(brand_sales_summary, F.col(_SOLD) > 0)
    return day.orderBy(F.desc(_SOLD), "brand_id").select(
        "brand_id", "brand_name", "sku_count", "order_count", "order_sku_num", _SOLD, "cart_count"
    )


def brand_top(brand_sales_summary: DataFrame, n: int = 15) -> DataFrame:
    return _first(_latest(brand_sales_summary, F.col(_SOLD) > 0), n, _SOLD, "brand_id").select("brand_name", _SOLD)


def category1_share(category1_sales_summary: DataFrame) -> DataFrame:
    """Sales and reductions per top category on the latest day."""
    day = _latest(category1_sales_summary, F.col(_SOLD) > 0)
    return day.orderBy(F.desc(_SOLD), "category1_id").select(
        "category1_name", _SOLD, "order_coupon_reduce", "order_activity_reduce"
    )


def sku_top(trade_sku_stats: DataFrame, measure: str = _SOLD, n: int = 20) -> DataFrame:
    """Best skus of the latest day, by amount or by ``order_sku_num``."""
    top = top_by(_latest(trade_sku_stats, F.col(_SOLD) > 0), ["dt"], measure, ["sku_id"], n)
    return top.orderBy("rn").select(
        "rn", "sku_name", "brand_name", "category3_name", "order_count", "order_sku_num", _SOLD, "cart_count"
    )


def traffic_kpis(log_traffic_overview: DataFrame) -> DataFrame:
    day = _latest(log_traffic_overview, F.col("total_pv") > 0)
    return day.select(
        "dt", "total_pv", "total_uv", F.round("avg_during_time", 0).alias("avg_during_time"), "total_jump_count"
    )


def traffic_trend(log_traffic_overview: DataFrame, days: int = 30) -> DataFrame:
    last = log_traffic_overview.orderBy(F.desc("dt")).limit(days)
    return last.select(
        epoch_ms(F.col("dt")).alias("time"), "total_pv", "total_uv", "total_during_time", "avg_during_time"
    )


def conversion_funnel(log_funnel_analysis: DataFrame) -> DataFrame:
    """The latest day's funnel as one row per stage."""
    day = _latest(log_funnel_analysis, F.col("browse_users") > 0)
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(c).alias("users")) for c, s in STAGES.items()])
    return day.select(F.inline(stages))


def rfm_segments(rfm_user_segmentation: DataFrame) -> DataFrame:
    counts = rfm_user_segmentation.groupBy("user_segment").agg(F.count(F.lit(1)).alias("user_count"))
    return counts.orderBy(F.desc("user_count"), "user_segment")


def rfm_user_top(rfm_user_segmentation: DataFrame, n: int = 20) -> DataFrame:
    return _first(rfm_user_segmentation, n, "monetary", "user_id").select(
        "user_id", "user_nick_name", "user_level", "recency", "frequency", "monetary", "user_segment"
    )


def big_region_amount(trade_region_stats: DataFrame) -> DataFrame:
    day = _latest(trade_region_stats, F.col(_SOLD) > 0)
    sums = day.groupBy("big_region").agg(F.sum(_SOLD).alias(_SOLD))
    return sums.orderBy(F.desc(_SOLD), "big_region")


def user_top(trade_user_stats: DataFrame, n: int = 20) -> DataFrame:
    top = top_by(_latest(trade_user_stats, F.col(_SOLD) > 0), ["dt"], _SOLD, ["user_id"], n)
    return top.orderBy("rn").select(
        "rn", "user_nick_name", "user_level", "order_count", _SOLD, "payment_total_amount", "refund_total_amount"
    )


def region_top(trade_region_stats: DataFrame, n: int = 10) -> DataFrame:
    return _first(_latest(trade_region_stats, F.col(_SOLD) > 0), n, _SOLD, "province_id").select(
        "region_name", "big_region", "order_count", _SOLD, "order_original_amount", "order_coupon_reduce"
    )


def brand_region_cross(brand_sales_summary: DataFrame, trade_region_stats: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` brand and region pairs, brands and regions each on their latest day.

    Pairs are ordered by brand first and region second, so the first ``n`` pairs
    use only the ``n`` first brands and the ``n`` first regions: both sides are
    cut to ``n`` rows before they meet.  Without regions a brand keeps NULLs.
    """
    brands = _first(_latest(brand_sales_summary, F.col(_SOLD) > 0), n, _SOLD, "brand_id")
    brands = brands.select("brand_id", "brand_name", F.col(_SOLD).alias("brand_amount"))
    regions = _first(_latest(trade_region_stats, F.col(_SOLD) > 0), n, _SOLD, "province_id")
    regions = regions.select("province_id", "region_name", F.col(_SOLD).alias("region_amount"))
    pairs = brands.join(F.broadcast(regions), F.lit(True), "left")
    order = [F.desc("brand_amount"), F.asc("brand_id"), F.desc("region_amount"), F.asc("province_id")]
    return pairs.orderBy(*order).limit(n).select("brand_name", "brand_amount", "region_name", "region_amount")
