"""Aggregates.  ``dt`` is a date from here on."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions import day_of
from shoplake.operators import lookup_join
from shoplake.operators.measures import Stats

_AMOUNT = "decimal(18,4)"
_USER = ("user_nick_name", "user_level", "age_range", "gender")
_SKU_NAMES = ("sku_name", "spu_name", "category3_name", "category2_name", "category1_name", "brand_name")


def _by_day(df: DataFrame, *keys: str) -> DataFrame:
    """The named columns with ``dt`` as a date."""
    return df.select(*[day_of(F.col("dt")).alias("dt") if k == "dt" else F.col(k) for k in keys])


def _sum(col: str, typ: str = _AMOUNT) -> Column:
    return F.sum(col).cast(typ)


def _rows() -> Column:
    return F.count(F.lit(1))


_SKU_ATTRS = (
    "sku_name", "spu_id", "spu_name", "category3_id", "category3_name", "category2_id", "category2_name",
    "category1_id", "category1_name", "brand_id", "brand_name",
)
_LOGS = {
    "log_startup": "startup_count",
    "log_page_view": "page_view_count",
    "log_action": "action_count",
    "log_display": "exposure_count",
    "log_error": "error_count",
}

# The aggregates that streams keep; facts in the order of the functions' parameters.
STATS = {
    "trade_user_stats": Stats(
        keys=("user_id", "dt"),
        attrs=_USER,
        types={
            "order_count": "bigint",
            "order_total_amount": _AMOUNT,
            "order_original_amount": _AMOUNT,
            "order_coupon_reduce": _AMOUNT,
            "payment_count": "bigint",
            "payment_total_amount": _AMOUNT,
            "refund_count": "bigint",
            "refund_total_amount": _AMOUNT,
            "refund_num": "bigint",
            "coupon_count": "bigint",
            "coupon_reduce_amount": _AMOUNT,
        },
        sources={
            "order_info": {
                "order_count": "1",
                "order_total_amount": "total_amount",
                "order_original_amount": "original_total_amount",
                "order_coupon_reduce": "coupon_reduce_amount",
            },
            "payment_info": {"payment_count": "1", "payment_total_amount": "total_amount"},
            "refund_info": {"refund_count": "1", "refund_total_amount": "refund_amount", "refund_num": "refund_num"},
            "coupon_use": {"coupon_count": "1", "coupon_reduce_amount": "coupon_reduce_amount"},
        },
    ),
    "trade_sku_stats": Stats(
        keys=("sku_id", "dt"),
        attrs=_SKU_ATTRS,
        types={
            "order_count": "bigint",
            "order_sku_num": "bigint",
            "order_total_amount": _AMOUNT,
            "order_coupon_reduce": _AMOUNT,
            "order_activity_reduce": _AMOUNT,
            "cart_count": "bigint",
            "cart_sku_num": "bigint",
        },
        sources={
            "order_detail": {
                "order_count": "1",
                "order_sku_num": "sku_num",
                "order_total_amount": "split_total_amount",
                "order_coupon_reduce": "split_coupon_amount",
                "order_activity_reduce": "split_activity_amount",
            },
            "cart_info": {"cart_count": "1", "cart_sku_num": "sku_num"},
        },
    ),
    "log_page_stats": Stats(
        keys=("page_id", "dt"),
        attrs=("page_name",),
        types={"pv": "bigint", "total_during_time": "bigint", "total_jump_count": "bigint"},
        sources={
            "log_page_view": {
                "pv": "1",
                "total_during_time": "coalesce(during_time, 0)",
                "total_jump_count": "coalesce(jump_count, 0)",
            }
        },
        distinct={"uv": "user_id"},
    ),
    "log_sku_exposure_stats": Stats(
        keys=("sku_id", "dt"),
        attrs=_SKU_NAMES,
        types={"exposure_count": "bigint"},
        sources={"log_display": {"exposure_count": "1"}},
        distinct={"exposure_user_count": "user_id"},
    ),
    "log_user_action_stats": Stats(
        keys=("user_id", "dt"),
        attrs=_USER,
        types=dict.fromkeys(_LOGS.values(), "bigint"),
        sources={log: {count: "1"} for log, count in _LOGS.items()},
    ),
}


@dataclass(frozen=True)
class Late:
    """Attributes of an aggregate that one of its keys finds in a dimension.

    All rows of a group have that key, so raw rows can be summed first and the groups look the attributes up, once each;
    ``given`` names attributes that only some facts carry, with the condition on a group that such a fact is in it.
    """

    key: str
    dim: str
    cols: Mapping[str, str]
    given: Mapping[str, str] = field(default_factory=dict)


_USER_COLS = {"user_nick_name": "nick_name", "user_level": "user_level", "age_range": "age_range", "gender": "gender"}
_COUPON_COLS = ("coupon_name", "full_amount", "reduce_amount", "use_condition")

LATE = {
    # Of the four facts only orders carry the gender.
    "trade_user_stats": Late("user_id", "dim.user_info", _USER_COLS, {"gender": "order_count > 0"}),
    # The name of a sku is the fact's own.
    "trade_sku_stats": Late("sku_id", "dim.sku_info", {c: c for c in _SKU_ATTRS if c != "sku_name"}),
    "log_sku_exposure_stats": Late("sku_id", "dim.sku_info", {c: c for c in _SKU_NAMES}),
    "log_user_action_stats": Late("user_id", "dim.user_info", _USER_COLS),
    "trade_region_stats": Late("province_id", "dim.base_region", {c: c for c in ("region_name", "big_region")}),
    # The type of a coupon is the fact's own.
    "trade_coupon_stats": Late("coupon_id", "dim.coupon_info", {c: c for c in _COUPON_COLS}),
}


def measures_of_raw(build: Callable[..., DataFrame], late: Late, raw: Sequence[DataFrame]) -> DataFrame:
    """The aggregate of raw facts, its late attributes NULL."""
    blank = {c: F.lit(None).cast("string") for c in late.cols}
    return build(*[f.withColumns(blank) for f in raw])


def with_late(measures: DataFrame, late: Late, dim: DataFrame) -> DataFrame:
    """The aggregate with its late attributes looked up; only one group a day can have a NULL key."""
    out = lookup_join(measures.drop(*late.cols), dim, (late.key, "id"), late.cols, identity=["dt"])
    out = out.withColumns({c: F.when(F.expr(cond), F.col(c)) for c, cond in late.given.items()}) if late.given else out
    return out.select(*measures.columns)


def trade_user_stats(
    order_info: DataFrame, payment_info: DataFrame, refund_info: DataFrame, coupon_use: DataFrame
) -> DataFrame:
    """Per user and day: orders, payments, refunds and coupons, whatever their status."""
    return STATS["trade_user_stats"].of(order_info, payment_info, refund_info, coupon_use)


def trade_sku_stats(order_detail: DataFrame, cart_info: DataFrame) -> DataFrame:
    """Per sku and day: order lines, units, amounts and cart additions."""
    return STATS["trade_sku_stats"].of(order_detail, cart_info)


def log_page_stats(log_page_view: DataFrame) -> DataFrame:
    """Per page and day: views, visitors, time and jumps."""
    return STATS["log_page_stats"].of(log_page_view)


def log_sku_exposure_stats(log_display: DataFrame) -> DataFrame:
    """Per sku and day: how often it was shown, and to how many users."""
    return STATS["log_sku_exposure_stats"].of(log_display)


def log_user_action_stats(
    log_startup: DataFrame,
    log_page_view: DataFrame,
    log_action: DataFrame,
    log_display: DataFrame,
    log_error: DataFrame,
) -> DataFrame:
    """Per user and day: how many rows of each log; a displayed list counts once per sku."""
    return STATS["log_user_action_stats"].of(log_startup, log_page_view, log_action, log_display, log_error)


def trade_region_stats(order_info: DataFrame) -> DataFrame:
    """Per province and day; a NULL province is a group of its own."""
    rows = _by_day(
        order_info, "province_id", "dt", "region_name", "big_region", "total_amount", "original_total_amount",
        "coupon_reduce_amount",
    )
    return rows.groupBy("province_id", "dt").agg(
        F.max("region_name").alias("region_name"),
        F.max("big_region").alias("big_region"),
        _rows().alias("order_count"),
        _sum("total_amount").alias("order_total_amount"),
        _sum("original_total_amount").alias("order_original_amount"),
        _sum("coupon_reduce_amount").alias("order_coupon_reduce"),
    )


def trade_coupon_stats(coupon_use: DataFrame) -> DataFrame:
    """Per coupon and day; a NULL coupon is a group of its own."""
    attrs = ("coupon_name", "coupon_type", "full_amount", "reduce_amount", "use_condition")
    rows = _by_day(coupon_use, "coupon_id", "dt", *attrs, "coupon_reduce_amount")
    return rows.groupBy("coupon_id", "dt").agg(
        *[F.max(a).alias(a) for a in attrs],
        _rows().alias("coupon_count"),
        _sum("coupon_reduce_amount").alias("coupon_reduce_amount"),
    )


def daily_active_users(log_page_view: DataFrame) -> DataFrame:
    rows = _by_day(log_page_view, "dt", "user_id", "create_time").where("user_id is not null")
    return rows.groupBy("dt", "user_id").agg(
        F.min("create_time").alias("first_action_time"), _rows().alias("page_view_count")
    )


def daily_order_users(order_info: DataFrame) -> DataFrame:
    rows = _by_day(order_info, "dt", "user_id", "create_time", "total_amount").where("user_id is not null")
    return rows.groupBy("dt", "user_id").agg(
        F.min("create_time").alias("first_order_time"),
        _rows().alias("order_count"),
        _sum("total_amount", "decimal(18,2)").alias("total_amount"),
    )


def page_transition_stats(log_page_view: DataFrame) -> DataFrame:
    rows = _by_day(log_page_view, "dt", "last_page_id", "page_id", "user_id", "mid").where("last_page_id != ''")
    return rows.groupBy("dt", "last_page_id", "page_id").agg(
        _rows().alias("transition_count"),
        F.count_distinct("user_id").alias("transition_users"),
        F.count_distinct("mid").alias("transition_sessions"),
    )


def gmv_hourly_trend(order_info: DataFrame) -> DataFrame:
    rows = order_info.where("user_id is not null").select(
        day_of(F.col("dt")).alias("dt"),
        F.hour("create_time").alias("hour"),
        "user_id",
        "total_amount",
        "original_total_amount",
        "coupon_reduce_amount",
    )
    return rows.groupBy("dt", "hour").agg(
        _rows().alias("order_count"),
        F.count_distinct("user_id").alias("order_users"),
        _sum("total_amount", "decimal(18,2)").alias("gmv"),
        _sum("original_total_amount", "decimal(18,2)").alias("original_amount"),
        _sum("coupon_reduce_amount", "decimal(18,2)").alias("coupon_reduce"),
    )


def log_error_stats(log_error: DataFrame) -> DataFrame:
    rows = _by_day(log_error, "dt", "err_code", "err_name", "user_id", "mid")
    return rows.groupBy("dt", "err_code").agg(
        F.max("err_name").alias("err_name"),
        _rows().alias("error_count"),
        F.count_distinct("user_id").alias("error_user_count"),
        F.count_distinct("mid").alias("error_device_count"),
    )
