"""Declared column types of every source table.  Nothing is inferred.

Times are zone-free (``timestamp_ntz``), ids are ``bigint`` and money is
``decimal``.  The day column ``dt`` is not part of a source table; the ODS
functions add it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Table name -> columns, in source order.
BASE_TABLES = {
    "coupon_info": "id bigint, coupon_type tinyint, full_amount decimal(18,2), reduce_amount decimal(18,2), "
    "coupon_name string, use_condition string, create_time timestamp_ntz, update_time timestamp_ntz",
    "base_brand": "id bigint, brand_name string, logo_url string, create_time timestamp_ntz, "
    "update_time timestamp_ntz",
    "base_category": "id bigint, category_name string, level tinyint, parent_id bigint, "
    "create_time timestamp_ntz, update_time timestamp_ntz",
    "base_region": "id bigint, region_code string, region_name string, level tinyint, parent_id bigint, "
    "big_region string, create_time timestamp_ntz",
    "spu_info": "id bigint, spu_name string, description string, category3_id bigint, brand_id bigint, "
    "create_time timestamp_ntz, update_time timestamp_ntz",
    "sku_info": "id bigint, sku_name string, spu_id bigint, category3_id bigint, brand_id bigint, "
    "price decimal(18,2), weight decimal(10,2), img_url string, is_sale tinyint, sku_attr string, "
    "create_time timestamp_ntz, update_time timestamp_ntz",
    "user_info": "id bigint, login_name string, nick_name string, name string, phone_num string, email string, "
    "user_level tinyint, birthday date, gender tinyint, age_range string, status smallint, "
    "create_time timestamp_ntz, update_time timestamp_ntz",
    "base_dic": "id bigint, dic_type string, code string, name string, sort int, create_time timestamp_ntz, "
    "update_time timestamp_ntz",
}

BUSINESS_TABLES = {
    "order_info": "id bigint, consignee string, consignee_tel string, total_amount decimal(18,2), "
    "order_status smallint, user_id bigint, payment_way tinyint, delivery_address string, "
    "order_comment string, out_trade_no string, trade_body string, create_time timestamp_ntz, "
    "operate_time timestamp_ntz, receive_time timestamp_ntz, expire_time timestamp_ntz, province_id int, "
    "coupon_reduce_amount decimal(18,2), original_total_amount decimal(18,2), update_time timestamp_ntz",
    "order_status_log": "id bigint, order_id bigint, order_status smallint, create_time timestamp_ntz",
    "order_detail": "id bigint, order_id bigint, order_line_no int, sku_id bigint, sku_name string, "
    "img_url string, order_price decimal(18,2), sku_num int, create_time timestamp_ntz, "
    "source_type smallint, source_id bigint, split_activity_amount decimal(18,4), coupon_id bigint, "
    "split_coupon_amount decimal(18,4), split_total_amount decimal(18,4), update_time timestamp_ntz",
    "cart_info": "id bigint, user_id bigint, sku_id bigint, sku_name string, category_id bigint, "
    "cart_price decimal(18,2), sku_num int, img_url string, sku_attr string, order_id bigint, "
    "is_checked boolean, create_time timestamp_ntz, operate_time timestamp_ntz, update_time timestamp_ntz",
    "payment_info": "id bigint, out_trade_no string, order_id bigint, user_id bigint, payment_type tinyint, "
    "trade_no string, total_amount decimal(18,2), payment_status smallint, create_time timestamp_ntz, "
    "callback_time timestamp_ntz, callback_content string, update_time timestamp_ntz",
    "refund_info": "id bigint, user_id bigint, order_id bigint, order_detail_id bigint, sku_name string, "
    "refund_amount decimal(18,2), refund_num int, refund_status smallint, refund_type tinyint, "
    "refund_reason string, refund_reason_type tinyint, create_time timestamp_ntz, "
    "refund_time timestamp_ntz, operate_time timestamp_ntz, update_time timestamp_ntz",
    "coupon_use": "id bigint, coupon_id bigint, coupon_type tinyint, user_id bigint, order_id bigint, "
    "coupon_status smallint, coupon_reduce_amount decimal(18,2), get_time timestamp_ntz, "
    "lock_time timestamp_ntz, using_time timestamp_ntz, used_time timestamp_ntz, "
    "expire_time timestamp_ntz, update_time timestamp_ntz",
}

LOG_TABLES = {
    "log_startup": "mid string, user_id bigint, appid string, os string, area string, version string, "
    "channel string, entry string, loading_time int, open_ad_id string, open_ad_ms int, "
    "create_time timestamp_ntz",
    "log_page_view": "mid string, user_id bigint, page_id string, page_name string, last_page_id string, "
    "jump_count int, during_time int, source_type string, create_time timestamp_ntz",
    "log_action": "mid string, user_id bigint, item_type string, item_id string, target_page_id string, "
    "create_time timestamp_ntz",
    "log_display": "mid string, user_id bigint, page_id string, display_type string, item_ids string, "
    "item_pos string, create_time timestamp_ntz",
    "log_error": "mid string, user_id bigint, appid string, err_code string, err_name string, "
    "err_content string, create_time timestamp_ntz",
}

TABLES = {**BASE_TABLES, **BUSINESS_TABLES, **LOG_TABLES}

# The four base tables read as whole snapshots; the other keyed tables arrive as row changes.
SNAPSHOT_TABLES = ("base_brand", "base_category", "base_dic", "base_region")

# The time column that gives ``dt``: create_time, except where listed here.
EVENT_TIME = {"coupon_use": "get_time"}


def fields(table: str) -> dict[str, str]:
    """Column name -> type text, in order."""
    out, depth, start, ddl = {}, 0, 0, TABLES[table] + ","
    for i, ch in enumerate(ddl):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            name, typ = ddl[start:i].strip().split(" ", 1)
            out[name] = typ
            start = i + 1
    return out


def text_ddl(table: str) -> str:
    """The table's columns, all as text: the wire form of JSON records."""
    return ", ".join(f"{c} string" for c in fields(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in order, typed; a missing column is NULL."""
    have = set(df.columns)
    return df.selectExpr(*[f"cast({f'`{c}`' if c in have else 'null'} as {t}) as `{c}`" for c, t in fields(table).items()])


def from_text(col: Column, typ: str) -> Column:
    """Text to a declared type; text that does not fit gives NULL, never an error.

    Times may be written as text or as epoch milliseconds, dates as text or as
    epoch days, as change-capture tools do.
    """
    if typ == "string":
        return col
    value = col.try_cast(typ)
    if typ == "timestamp_ntz":
        secs = (col.try_cast("decimal(20,0)") / 1000).cast("decimal(18,6)")
        zero = F.lit(0)
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        whole = F.when(col.rlike("^-?[0-9]{9,}$"), epoch + F.make_dt_interval(zero, zero, zero, secs))
        return F.coalesce(whole, value)
    if typ == "date":
        days = F.when(col.rlike("^-?[0-9]{1,6}$"), F.date_add(F.lit("1970-01-01").cast("date"), col.try_cast("int")))
        return F.coalesce(days, value)
    if typ in ("bigint", "int", "smallint", "tinyint"):
        return F.when(col.rlike(r"^\s*[+-]?[0-9]+\s*$"), value)
    return value
