"""The shop's source tables derived from the driver's star-schema tables.

Both the Spark queries and the SQL they are checked against start from these
rows, so the statements use only what both dialects share.  Three markers
differ: ``{JSON_K}`` reads the number in ``events.props``, ``{TS}`` is the
zone-free timestamp keyword and names in braces are tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

# Money is floored to whole cents before it becomes a decimal: double to decimal casts round differently
# between engines.
_CENTS = "cast(cast(floor({x}) as bigint) * cast(0.01 as decimal(3,2)) as decimal(18,2))"


def _cents(expr: str) -> str:
    return _CENTS.replace("{x}", expr)


_LI_ORDER = ", ".join(
    f"l_{c} desc"
    for c in (
        "shipdate", "partkey", "suppkey", "extendedprice", "quantity", "discount", "tax", "returnflag", "linestatus"
    )
)


def _page(k: str) -> str:
    return (
        f"case when {k} < 40 then 'sku_detail' when {k} % 4 = 0 then 'home' when {k} % 4 = 1 then 'search' "
        f"when {k} % 4 = 2 then 'cart' else 'mine' end"
    )


STATEMENTS = {
    # lineitem repeats (orderkey, linenumber): the newest line wins, as in a keyed table.
    "li": "select * from (select *, row_number() over (partition by l_orderkey, l_linenumber "
    f"order by {_LI_ORDER}) as _rn from {{lineitem}}) t where _rn = 1",
    # Types and sizes are code lists (some hundred at most), so numbering the types in one window is cheap.
    "pt": "select distinct p_type, p_size from {part}",
    "ty": "select p_type, dense_rank() over (order by p_type) as t_rank from (select distinct p_type from {pt}) x",
    "pc": "select p.p_type, p_size, t_rank from {pt} p join {ty} ty on p.p_type = ty.p_type",
    "ev": "select event_id, ts, user_id, event_type, cast({JSON_K} as bigint) as k, value, "
    "concat('mid_', cast(user_id % 50 as string)) as mid from {events}",
    "pv": "select event_id, mid, user_id, k, value, ts from {ev} where event_type = 'view'",
    "base_brand": "select distinct cast(substring(p_brand, 7) as bigint) as id, p_brand as brand_name from {part}",
    "base_category": "select 10000 + t_rank * 100 + p_size as id, concat(p_type, '/', cast(p_size % 3 as string), '/', "
    "cast(p_size as string)) as category_name, cast(3 as tinyint) as level, 1000 + t_rank * 10 + p_size % 3 as parent_id "
    "from {pc} union all select distinct 1000 + t_rank * 10 + p_size % 3, concat(p_type, '/', "
    "cast(p_size % 3 as string)), cast(2 as tinyint), 100 + t_rank from {pc} "
    "union all select 100 + t_rank, p_type, cast(1 as tinyint), cast(null as bigint) from {ty}",
    # The code table lists the codes that occur.
    "base_dic": "select cast(type_no * 100 + dense_rank() over (partition by dic_type order by code) as bigint) as id, "
    "dic_type, code, concat(dic_type, ':', code) as name, "
    "cast(dense_rank() over (partition by dic_type order by code) as int) as sort from ("
    "select distinct 1 as type_no, 'order_status' as dic_type, o_orderstatus as code from {orders} "
    "union all select distinct 2, 'order_priority', o_orderpriority from {orders} "
    "union all select distinct 3, 'return_flag', l_returnflag from {lineitem} "
    "union all select distinct 4, 'event_type', event_type from {events}) c",
    "base_region": "select cast(n_nationkey as bigint) as id, n_name as region_name, cast(1 as tinyint) as level, "
    "r_name as big_region from {nation} join {region} on n_regionkey = r_regionkey",
    "coupon_info": "select distinct cast(round(l_discount * 100) as bigint) as id, "
    "cast(case when l_discount > 0.05 then 1 else 2 end as tinyint) as coupon_type, "
    "cast(round(l_discount * 10000) as decimal(18,2)) as full_amount, "
    "cast(round(l_discount * 1000) as decimal(18,2)) as reduce_amount, "
    "concat('coupon_', cast(cast(round(l_discount * 100) as bigint) as string)) as coupon_name "
    "from {lineitem} where l_discount > 0",
    "spu_info": "select cast(floor(p_partkey / 4.0) as bigint) as id, max(p_name) as spu_name, "
    "max(10000 + t_rank * 100 + p_size) as category3_id, max(cast(substring(p_brand, 7) as bigint)) as brand_id "
    "from {part} p join {ty} ty on p.p_type = ty.p_type group by 1",
    "sku_info": "select p_partkey as id, p_name as sku_name, cast(floor(p_partkey / 4.0) as bigint) as spu_id, "
    "10000 + t_rank * 100 + p_size as category3_id, cast(substring(p_brand, 7) as bigint) as brand_id, "
    "cast(p_retailprice as decimal(18,2)) as price from {part} p join {ty} ty on p.p_type = ty.p_type",
    "user_info": "select c_custkey as id, c_name as login_name, c_name as nick_name, "
    "cast(c_custkey % 6 + 1 as tinyint) as user_level, cast(c_custkey % 3 as tinyint) as gender, "
    "case c_custkey % 4 when 0 then '18-25' when 1 then '26-35' when 2 then '36-45' else '46+' end as age_range "
    "from {customer}",
    # Orders are spread over 60 days from 2024-01-01, so they overlap with the events.
    "order_info": "select o_orderkey as id, o_custkey as user_id, cast(o_totalprice as decimal(18,2)) as total_amount, "
    f"{_cents('o_totalprice * (o_orderkey % 10)')} as coupon_reduce_amount, "
    f"cast(cast(o_totalprice as decimal(18,2)) + {_cents('o_totalprice * (o_orderkey % 10)')} as decimal(18,2)) "
    "as original_total_amount, cast(case o_orderstatus when 'F' then 1005 when 'P' then 1003 else 1001 end as smallint) "
    "as order_status, c_nationkey as province_id, {TS} '2024-01-01 00:00:00' + interval '1' hour * "
    "cast((o_orderkey % 60) * 24 + o_custkey % 24 as int) as create_time "
    "from {orders} join {customer} on o_custkey = c_custkey",
    "order_detail": "select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, "
    "l_linenumber as order_line_no, l_partkey as sku_id, concat('sku_', cast(l_partkey as string)) as sku_name, "
    f"{_cents('l_extendedprice * 100 / l_quantity')} as order_price, cast(l_quantity as int) as sku_num, "
    "o.create_time, cast(case when l_discount > 0 then round(l_discount * 100) end as bigint) as coupon_id, "
    "cast(round(l_extendedprice * l_discount, 4) as decimal(18,4)) as split_coupon_amount, "
    "cast(round(l_extendedprice * l_tax, 4) as decimal(18,4)) as split_activity_amount, "
    "cast(l_extendedprice as decimal(18,4)) as split_total_amount from {li} l join {order_info} o on l_orderkey = o.id",
    "payment_info": "select id, id as order_id, user_id, cast(id % 4 + 1 as tinyint) as payment_type, total_amount, "
    "cast(1002 as smallint) as payment_status, create_time + interval '5' minute as create_time "
    "from {order_info} where order_status <> 1001",
    "refund_info": "select l_orderkey * 10 + l_linenumber as id, o.user_id, l_orderkey as order_id, "
    "l_orderkey * 10 + l_linenumber as order_detail_id, cast(l_extendedprice as decimal(18,2)) as refund_amount, "
    "cast(l_quantity as int) as refund_num, cast(703 as smallint) as refund_status, "
    "o.create_time + interval '1' day as create_time from {li} l join {order_info} o on l_orderkey = o.id "
    "where l_returnflag = 'R'",
    "coupon_use": "select l_orderkey * 10 + l_linenumber as id, cast(round(l_discount * 100) as bigint) as coupon_id, "
    "cast(case when l_discount > 0.05 then 1 else 2 end as tinyint) as coupon_type, o.user_id, "
    "l_orderkey as order_id, cast(1402 as smallint) as coupon_status, "
    f"{_cents('l_extendedprice * l_discount * 100')} as coupon_reduce_amount, "
    "o.create_time - interval '1' day as get_time from {li} l join {order_info} o on l_orderkey = o.id "
    "where l_discount > 0.05",
    "order_status_log": "select id * 10 + 1 as id, id as order_id, cast(1001 as smallint) as order_status, "
    "create_time from {order_info} union all select id * 10 + 3, id, cast(1003 as smallint), "
    "create_time + interval '5' minute from {order_info} where order_status <> 1001 "
    "union all select id * 10 + 5, id, cast(1005 as smallint), create_time + interval '2' day "
    "from {order_info} where order_status = 1005",
    "cart_info": "select event_id as id, user_id, k as sku_id, concat('sku_', cast(k as string)) as sku_name, "
    "cast(value as decimal(18,2)) as cart_price, cast(k % 3 + 1 as int) as sku_num, ts as create_time "
    "from {ev} where event_type = 'purchase'",
    "log_startup": "select mid, user_id, case when k % 2 = 0 then 'ios' else 'android' end as os, "
    "cast(floor(value) as int) as loading_time, ts as create_time from {ev} where event_type = 'signup'",
    # The previous page is part of the record, as in the shop's logs: NULL or empty on a first page.
    "log_page_view": f"select mid, user_id, {_page('k')} as page_id, concat('page_', {_page('k')}) as page_name, "
    f"case when k % 13 = 0 then null when k % 17 = 0 then '' else {_page('((k * 7 + event_id) % 100)')} end "
    "as last_page_id, cast(k % 6 as int) as jump_count, "
    "case when k % 10 = 0 then null else cast(floor(value * 100) as int) end as during_time, ts as create_time "
    "from {pv}",
    "log_action": "select mid, user_id, case when k % 2 = 0 then 'sku' else 'brand' end as item_type, "
    "cast(k as string) as item_id, ts as create_time from {ev} where event_type = 'click'",
    "log_display": f"select mid, user_id, {_page('k')} as page_id, concat(cast(k as string), ',', "
    "cast(k + 1 as string), ',', cast(k + 7 as string)) as item_ids, '1,2,3' as item_pos, ts as create_time "
    "from {pv} where k % 2 = 0",
    "log_error": "select mid, user_id, concat('E', cast(k % 5 as string)) as err_code, "
    "concat('error_', cast(k % 5 as string)) as err_name, ts as create_time from {ev} where event_type = 'error'",
}

_NAME = re.compile(r"\{(\w+)\}")


def inputs_of(name: str) -> list[str]:
    """Tables a statement reads."""
    return [n for n in dict.fromkeys(_NAME.findall(STATEMENTS[name])) if n not in ("JSON_K", "TS")]


def adapted(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Lazy access to the driver's tables and to every derived table, by name."""
    known: dict[str, DataFrame] = {}
    words = {"JSON_K": "get_json_object(props, '$.k')", "TS": "timestamp_ntz"}

    def get(name: str) -> DataFrame:
        if name not in known:
            if name in STATEMENTS:
                tables = {n: get(n) for n in inputs_of(name)}
                text = STATEMENTS[name].replace("{JSON_K}", words["JSON_K"]).replace("{TS}", words["TS"])
                known[name] = spark.sql(text, **tables)
            else:
                known[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return known[name]

    return get
