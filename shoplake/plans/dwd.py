"""Enriched facts: raw facts with the dimension values of the moment they are processed.

A later change of a dimension does not touch facts already written.  Change
columns (``_op``, ``_ts``, ``_seq``) of a fact, when present, are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.operators import explode_ids, lookup_join
from shoplake.operators.changelog import META

_USER = {"user_nick_name": "nick_name", "user_level": "user_level", "age_range": "age_range"}
_USER_GENDER = {**_USER, "gender": "gender"}
_SKU_NAMES = {c: c for c in ("spu_name", "category3_name", "category2_name", "category1_name", "brand_name")}
_SKU = {
    c: c
    for c in (
        "spu_id", "spu_name", "category3_id", "category3_name", "category2_id", "category2_name",
        "category1_id", "category1_name", "brand_id", "brand_name",
    )
}


def _shape(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[c for c in META if c in df.columns])


def bare(table: str, ods: DataFrame) -> DataFrame:
    """The rows of a fact with their own columns only: nothing is looked up."""
    return explode_ids(ods, "item_ids") if table == "log_display" else ods


def cart_info(ods: DataFrame, dim_sku: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_sku, ("sku_id", "id"), _SKU)
    out = lookup_join(out, dim_user, ("user_id", "id"), _USER)
    return _shape(
        out, "id", "user_id", *_USER, "sku_id", "sku_name", *_SKU, "category_id", "cart_price", "sku_num",
        "img_url", "sku_attr", "order_id", "is_checked", "create_time", "operate_time", "update_time", "dt",
    )


def coupon_use(ods: DataFrame, dim_user: DataFrame, dim_coupon: DataFrame) -> DataFrame:
    """The coupon type is the fact's own; the other coupon columns come from the template."""
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER)
    template = {c: c for c in ("coupon_name", "full_amount", "reduce_amount", "use_condition")}
    out = lookup_join(out, dim_coupon, ("coupon_id", "id"), template)
    return _shape(
        out, "id", "coupon_id", "coupon_name", "coupon_type", "coupon_reduce_amount", "full_amount",
        "reduce_amount", "use_condition", "user_id", *_USER, "order_id", "coupon_status", "get_time",
        "lock_time", "using_time", "used_time", "expire_time", "update_time", "dt",
    )


def order_detail(ods: DataFrame, dim_sku: DataFrame, dim_coupon: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_sku, ("sku_id", "id"), _SKU)
    template = {"coupon_name": "coupon_name", "coupon_type": "coupon_type"}
    out = lookup_join(out, dim_coupon, ("coupon_id", "id"), template)
    return _shape(
        out, "id", "order_id", "order_line_no", "sku_id", "sku_name", *_SKU, "img_url", "order_price",
        "sku_num", "create_time", "source_type", "source_id", "split_activity_amount", "coupon_id",
        "coupon_name", "coupon_type", "split_coupon_amount", "split_total_amount", "update_time", "dt",
    )


def order_info(ods: DataFrame, dim_user: DataFrame, dim_region: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    out = lookup_join(out, dim_region, ("province_id", "id"), {"region_name": "region_name", "big_region": "big_region"})
    return _shape(
        out, "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", *_USER_GENDER,
        "payment_way", "delivery_address", "order_comment", "out_trade_no", "trade_body", "create_time",
        "operate_time", "receive_time", "expire_time", "province_id", "region_name", "big_region",
        "coupon_reduce_amount", "original_total_amount", "update_time", "dt",
    )


def order_status_log(ods: DataFrame) -> DataFrame:
    return _shape(ods, "id", "order_id", "order_status", "create_time", "dt")


def payment_info(ods: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER)
    return _shape(
        out, "id", "out_trade_no", "order_id", "user_id", *_USER, "payment_type", "trade_no", "total_amount",
        "payment_status", "create_time", "callback_time", "callback_content", "update_time", "dt",
    )


def refund_info(ods: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER)
    return _shape(
        out, "id", "user_id", *_USER, "order_id", "order_detail_id", "sku_name", "refund_amount",
        "refund_num", "refund_status", "refund_type", "refund_reason", "refund_reason_type", "create_time",
        "refund_time", "operate_time", "update_time", "dt",
    )


def log_startup(ods: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    return _shape(
        out, "mid", "user_id", "appid", "os", "area", "version", "channel", "entry", "loading_time",
        "open_ad_id", "open_ad_ms", *_USER_GENDER, "create_time", "dt",
    )


def log_page_view(ods: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    return _shape(
        out, "mid", "user_id", "page_id", "page_name", "last_page_id", "jump_count", "during_time",
        "source_type", *_USER_GENDER, "create_time", "dt",
    )


def log_action(ods: DataFrame, dim_user: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Only actions on a sku get sku columns; other item ids are not sku ids."""
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    sku = {"sku_name": "sku_name", **_SKU_NAMES}
    item = F.col("item_id").try_cast("bigint")
    out = lookup_join(out, dim_sku, (item, "id"), sku, cond=F.col("item_type") == "sku")
    return _shape(
        out, "mid", "user_id", "item_type", "item_id", "target_page_id", *_USER_GENDER, *sku, "create_time", "dt"
    )


def log_display(ods: DataFrame, dim_user: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """One row per displayed sku; the position list stays as it is."""
    # Look the user up before the rows multiply.
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    sku = {"sku_name": "sku_name", **_SKU_NAMES}
    out = lookup_join(explode_ids(out, "item_ids"), dim_sku, ("sku_id", "id"), sku)
    return _shape(
        out, "mid", "user_id", "page_id", "display_type", "item_ids", "item_pos", "sku_id", *sku,
        *_USER_GENDER, "create_time", "dt",
    )


def log_error(ods: DataFrame, dim_user: DataFrame) -> DataFrame:
    out = lookup_join(ods, dim_user, ("user_id", "id"), _USER_GENDER)
    return _shape(
        out, "mid", "user_id", "appid", "err_code", "err_name", "err_content", *_USER_GENDER, "create_time", "dt"
    )
