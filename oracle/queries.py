"""Query key -> complete SQL."""

from __future__ import annotations

import re
from functools import cache

from oracle.layers import TABLES
from oracle.text import out
from shoplake import schemas
from shoplake.sources.adapter import DRIVER_TABLES

_WORD = re.compile(r"\b[a-z_0-9]+\b")

_U = "user_nick_name user_level:i age_range"
_UG = _U + " gender:i"
_CAT = "category3_id:i category3_name category2_id:i category2_name category1_id:i category1_name"
_S = f"spu_id:i spu_name {_CAT} brand_id:i brand_name"
_SN = "sku_name spu_name category3_name category2_name category1_name brand_name"


def _declared(table: str) -> str:
    """All declared columns of a source table, and the day of those that have one."""
    kinds = {"timestamp_ntz": ":t", "date": ":d", "string": "", "boolean": ""}
    cols = [c + kinds.get(t, ":m" if t.startswith("decimal") else ":i") for c, t in schemas.fields(table).items()]
    return " ".join(cols if table in schemas.BASE_TABLES else [*cols, "dt"])


_USER_STATS = (
    "order_count:i order_total_amount:m order_original_amount:m order_coupon_reduce:m payment_count:i "
    "payment_total_amount:m refund_count:i refund_total_amount:m refund_num:i coupon_count:i coupon_reduce_amount:m"
)
_SKU_STATS = (
    "order_count:i order_sku_num:i order_total_amount:m order_coupon_reduce:m order_activity_reduce:m cart_count:i "
    "cart_sku_num:i"
)
_TOTALS = (
    "total_original_amount:m total_coupon_reduce:m total_payment_count:i total_payment_amount:m "
    "total_refund_count:i total_refund_amount:m total_coupon_count:i total_coupon_reduce_amount:m"
)
_RATES = "payment_conversion_rate:m refund_rate:m avg_order_amount:m coupon_usage_rate:m"
_REGION = (
    "dt:d province_id:i region_name big_region order_count:i order_total_amount:m order_original_amount:m "
    "order_coupon_reduce:m"
)
_COUPON = (
    "dt:d coupon_id:i coupon_name coupon_type:i full_amount:m reduce_amount:m use_condition coupon_count:i coupon_reduce_amount:m"
)
_ERR = "dt:d err_code err_name error_count:i error_user_count:i error_device_count:i"
_HOURLY = "dt:d hour:i order_count:i order_users:i gmv:m original_amount:m coupon_reduce:m"
_SOLD = "order_total_amount:m"
_TREND = "dt:d sku_id:i sku_name spu_name category1_name brand_name order_count:i"
_RFM = "user_id:i user_nick_name user_level:i recency:i frequency:i monetary:m"

# key -> (table, output columns)
SPECS: dict[str, tuple[str, str]] = {
    "dws_trade_user_stats": ("dws_trade_user_stats", f"user_id:i dt:d {_UG} {_USER_STATS}"),
    "dws_trade_sku_stats": ("dws_trade_sku_stats", f"sku_id:i dt:d sku_name {_S} {_SKU_STATS}"),
    "dws_log_page_stats": (
        "dws_log_page_stats",
        "page_id dt:d page_name pv:i uv:i total_during_time:i total_jump_count:i",
    ),
    "dws_log_sku_exposure_stats": (
        "dws_log_sku_exposure_stats",
        f"sku_id:i dt:d {_SN} exposure_count:i exposure_user_count:i",
    ),
    "dws_log_user_action_stats": (
        "dws_log_user_action_stats",
        f"user_id:i dt:d {_UG} startup_count:i page_view_count:i action_count:i exposure_count:i error_count:i",
    ),
    "dws_trade_region_stats": ("dws_trade_region_stats", _REGION),
    "dws_trade_coupon_stats": ("dws_trade_coupon_stats", _COUPON),
    "dws_daily_active_users": ("dws_daily_active_users", "dt:d user_id:i first_action_time:t page_view_count:i"),
    "dws_daily_order_users": (
        "dws_daily_order_users",
        "dt:d user_id:i first_order_time:t order_count:i total_amount:m",
    ),
    "dws_page_transition_stats": (
        "dws_page_transition_stats",
        "dt:d last_page_id page_id transition_count:i transition_users:i transition_sessions:i",
    ),
    "dws_gmv_hourly_trend": ("dws_gmv_hourly_trend", _HOURLY),
    "dws_log_error_stats": ("dws_log_error_stats", _ERR),
    "ads_daily_trade_overview": (
        "ads_daily_trade_overview",
        f"dt:d total_order_count:i total_order_amount:m {_TOTALS}",
    ),
    "ads_user_trade_ranking": (
        "ads_user_trade_ranking",
        "dt:d user_id:i user_nick_name user_level:i order_count:i order_total_amount:m payment_total_amount:m "
        "refund_total_amount:m rn_order:i rn_payment:i",
    ),
    "ads_sku_sales_ranking": (
        "ads_sku_sales_ranking",
        f"dt:d sku_id:i {_SN} order_count:i order_sku_num:i order_total_amount:m cart_count:i rn_amount:i rn_qty:i",
    ),
    "ads_region_trade_overview": ("ads_region_trade_overview", f"{_REGION} rn:i"),
    "ads_coupon_analysis": ("dws_trade_coupon_stats", _COUPON),
    "ads_category1_sales_summary": (
        "ads_category1_sales_summary",
        f"dt:d category1_id:i category1_name sku_count:i {_SKU_STATS}",
    ),
    "ads_brand_sales_summary": (
        "ads_brand_sales_summary",
        "dt:d brand_id:i brand_name sku_count:i order_count:i order_sku_num:i order_total_amount:m cart_count:i",
    ),
    "ads_log_traffic_overview": (
        "ads_log_traffic_overview",
        "dt:d total_pv:i total_uv:i total_during_time:i avg_during_time:m total_jump_count:i",
    ),
    "ads_log_page_ranking": (
        "ads_log_page_ranking",
        "dt:d page_id page_name pv:i uv:i total_during_time:i avg_during_time:m rn_pv:i rn_uv:i",
    ),
    "ads_log_sku_exposure_ranking": (
        "ads_log_sku_exposure_ranking",
        f"sku_id:i dt:d {_SN} exposure_count:i exposure_user_count:i rn_exposure:i rn_exposure_user:i",
    ),
    "ads_log_user_activity_ranking": (
        "ads_log_user_activity_ranking",
        "dt:d user_id:i user_nick_name user_level:i startup_count:i page_view_count:i action_count:i "
        "exposure_count:i error_count:i total_action_count:i rn:i",
    ),
    "ads_log_error_analysis": ("dws_log_error_stats", _ERR),
    "ads_user_first_active": ("ads_user_first_active", "user_id:i first_active_dt:d"),
    "ads_user_first_order": ("ads_user_first_order", "user_id:i first_order_dt:d"),
    "ads_log_funnel_analysis": (
        "ads_log_funnel_analysis",
        "dt:d browse_users:i action_users:i cart_users:i order_users:i",
    ),
    "ads_user_browse_retention": (
        "ads_user_browse_retention",
        "dt:d new_users:i day1_retained:i day7_retained:i day30_retained:i day1_retention_rate:m "
        "day7_retention_rate:m day30_retention_rate:m",
    ),
    "ads_user_purchase_retention": (
        "ads_user_purchase_retention",
        "dt:d new_buyers:i day1_repurchase:i day7_repurchase:i day30_repurchase:i day1_repurchase_rate:m "
        "day7_repurchase_rate:m day30_repurchase_rate:m",
    ),
    "ads_page_transition_matrix": (
        "ads_page_transition_matrix",
        "dt:d from_page to_page transition_count:i transition_users:i transition_sessions:i is_bounce:i rn:i",
    ),
    "ads_user_path_top10": ("ads_user_path_top10", "dt:d path transition_count:i transition_users:i rn:i"),
    "ads_page_outflow_top3": (
        "ads_page_outflow_top3",
        "dt:d from_page to_page transition_count:i transition_users:i rn:i",
    ),
    "ads_rfm_user_segmentation": (
        "ads_rfm_user_segmentation",
        f"{_RFM} r_score:i f_score:i m_score:i user_segment",
    ),
    "ads_rfm_segment_summary": (
        "ads_rfm_segment_summary",
        "user_segment user_count:i user_pct:m total_orders:i total_amount:m amount_pct:m avg_recency:m "
        "avg_frequency:m avg_monetary:m",
    ),
    "ads_gmv_realtime_dashboard": (
        "ads_gmv_realtime_dashboard",
        f"dt:d total_order_count:i total_gmv:m {_TOTALS} {_RATES}",
    ),
    "ads_gmv_hourly_trend": ("ads_gmv_hourly_trend", f"{_HOURLY} gmv_hourly_growth_rate:m cumulative_gmv:m"),
    "ads_sku_sales_trend": (
        "ads_sku_sales_trend",
        f"{_TREND} order_sku_num:i order_total_amount:m cart_count:i avg_7d_order_count:m avg_7d_amount:m "
        "avg_7d_cart_count:m daily_growth_rate:m",
    ),
    "ads_sku_sales_anomaly": (
        "ads_sku_sales_anomaly",
        f"{_TREND} avg_7d_order_count:m order_total_amount:m avg_7d_amount:m deviation_rate:m anomaly_type",
    ),
    "ads_category_sales_trend": (
        "ads_category_sales_trend",
        "dt:d category1_name total_order_count:i total_sku_num:i total_amount:m total_cart_count:i "
        "avg_7d_order_count:m avg_7d_amount:m amount_pct:m",
    ),
}

# Raw tables, dimensions and facts: every declared column, and those looked up.
for _table in schemas.TABLES:
    _raw = _table if _table in schemas.BASE_TABLES else f"ods_{_table}"
    SPECS[f"ods_{_table}"] = (_raw, _declared(_table))
for _table in ("base_brand", "base_dic", "base_region", "coupon_info", "user_info"):
    SPECS[f"dim_{_table}"] = (_table, _declared(_table))
for _table, _looked_up in {
    "base_category": _CAT,
    "spu_info": f"{_CAT.partition(' ')[2]} brand_name",
    "sku_info": f"spu_name {_CAT.partition(' ')[2]} brand_name",
}.items():
    SPECS[f"dim_{_table}"] = (f"dim_{_table}", f"{_declared(_table)} {_looked_up}")
for _table, _looked_up in {
    "cart_info": f"{_U} {_S}",
    "coupon_use": f"{_U} coupon_name full_amount:m reduce_amount:m use_condition",
    "order_detail": f"{_S} coupon_name coupon_type:i",
    "order_info": f"{_UG} region_name big_region",
    "order_status_log": "",
    "payment_info": _U,
    "refund_info": _U,
    "log_startup": _UG,
    "log_page_view": _UG,
    "log_action": f"{_UG} {_SN}",
    "log_display": f"sku_id:i {_UG} {_SN}",
    "log_error": _UG,
}.items():
    SPECS[f"dwd_{_table}"] = (f"dwd_{_table}", f"{_declared(_table)} {_looked_up}")

# A stream must end where the batch plan does.
for _stream, _batch in {
    "stream_log_ingest": "ods_log_page_view",
    "stream_page_stats": "dws_log_page_stats",
    "stream_cdc_upsert": "ods_order_info",
    "stream_trade_user_stats": "dws_trade_user_stats",
    "stream_sku_exposure_stats": "dws_log_sku_exposure_stats",
    "stream_user_action_stats": "dws_log_user_action_stats",
    "stream_late_rows_kept": "dws_log_page_stats",
    "stream_trade_sku_stats": "dws_trade_sku_stats",
    "stream_dim_sku_info": "dim_sku_info",
    "src_cdc_handoff": "ods_order_info",
    "mv_refresh_changed_days": "dws_trade_region_stats",
    "stream_restart_idempotent": "dwd_cart_info",
    "view_registration": "ads_region_trade_overview",
}.items():
    SPECS[_stream] = SPECS[_batch]


def _last(table: str, cond: str) -> str:
    return f"dt = (select max(z.dt) from {table} z where {cond})"


_GMV, _DAYS = "ads_gmv_realtime_dashboard", "ads_daily_trade_overview"
_BRAND, _CAT1 = "ads_brand_sales_summary", "ads_category1_sales_summary"
_SOLD_DAY = "z.order_total_amount > 0"
_TRAFFIC, _FUNNEL = "ads_log_traffic_overview", "ads_log_funnel_analysis"
_KPI_DAY = _last(_GMV, "z.total_gmv > 0 or z.total_order_count > 0")
_SKU_TOP = "sku_name brand_name category3_name order_count:i order_sku_num:i order_total_amount:m cart_count:i"
_ALL = (
    "select 'user_info' as name, count(*) as cnt from user_info "
    + " ".join(
        f"union all select '{t}', count(*) from {t}"
        for t in (
            "base_brand base_category base_dic base_region coupon_info sku_info spu_info cart_info coupon_use "
            "order_detail order_info order_status_log payment_info refund_info"
        ).split()
    )
    + " union all select 'dwd.order_info', count(*) from dwd_order_info"
    + " union all select 'dws.trade_user_stats', count(*) from dws_trade_user_stats"
    + " union all select 'ads.gmv_realtime_dashboard', count(*) from ads_gmv_realtime_dashboard"
)

REPORTS: dict[str, str] = {
    "ads_gmv_today_summary": out(
        _GMV,
        f"dt:d total_order_count:i total_gmv:m total_payment_amount:m total_refund_amount:m {_RATES}",
        "where dt = date '2024-02-29'",
    ),
    "rpt_trade_kpis": "select strftime(dt, '%Y-%m-%d') as dt, cast(total_gmv as double) as total_gmv, "
    "cast(total_order_count as bigint) as total_order_count, cast(total_payment_amount as double) as "
    "total_payment_amount, printf('%.2f', payment_conversion_rate) || '%' as payment_conversion_rate, "
    "avg_order_amount, printf('%.2f', refund_rate) || '%' as refund_rate, "
    "printf('%.2f', coupon_usage_rate) || '%' as coupon_usage_rate, "
    "cast(total_coupon_count as bigint) as total_coupon_count, cast(total_coupon_reduce_amount as double) as "
    f"total_coupon_reduce_amount from {_GMV} where {_KPI_DAY}",
    "rpt_trade_trend_30d": out(
        f"(select *, epoch_ms(cast(dt as timestamp)) as time from {_DAYS})",
        "time:i total_order_amount:m total_payment_amount:m total_order_count:i total_payment_count:i",
        "order by dt desc limit 30",
    ).replace("order by dt", "order by time"),
    "rpt_daily_trade_detail": out(
        f"(select * from {_DAYS} order by dt desc limit 10)",
        "dt:d total_order_count:i total_order_amount:m total_payment_amount:m total_refund_amount:m "
        "total_coupon_reduce_amount:m",
    ),
    "rpt_brand_top15": out(
        f"(select * from {_BRAND} where {_last(_BRAND, _SOLD_DAY)} order by order_total_amount desc, brand_id limit 15)",
        f"brand_name {_SOLD}",
    ),
    "rpt_brand_detail": out(
        _BRAND,
        f"brand_id:i brand_name sku_count:i order_count:i order_sku_num:i {_SOLD} cart_count:i",
        f"where {_last(_BRAND, _SOLD_DAY)}",
    ),
    "rpt_category1_share": out(
        _CAT1,
        f"category1_name {_SOLD} order_coupon_reduce:m order_activity_reduce:m",
        f"where {_last(_CAT1, _SOLD_DAY)}",
    ),
    "rpt_sku_top20_amount": out(
        "(select *, rn_amount as rn from ads_sku_sales_ranking)",
        f"rn:i {_SKU_TOP}",
        f"where rn_amount <= 20 and {_last('dws_trade_sku_stats', _SOLD_DAY)}",
    ),
    "rpt_sku_top20_qty": out(
        "(select *, rn_qty as rn from ads_sku_sales_ranking)",
        f"rn:i {_SKU_TOP}",
        f"where rn_qty <= 20 and {_last('dws_trade_sku_stats', _SOLD_DAY)}",
    ),
    "rpt_traffic_kpis": "select strftime(dt, '%Y-%m-%d') as dt, cast(total_pv as bigint) as total_pv, "
    "cast(total_uv as bigint) as total_uv, round(avg_during_time) as avg_during_time, "
    f"cast(total_jump_count as bigint) as total_jump_count from {_TRAFFIC} where {_last(_TRAFFIC, 'z.total_pv > 0')}",
    "rpt_traffic_trend_30d": out(
        f"(select *, epoch_ms(cast(dt as timestamp)) as time from {_TRAFFIC} order by dt desc limit 30)",
        "time:i total_pv:i total_uv:i total_during_time:i avg_during_time:m",
    ),
    "rpt_conversion_funnel": " union all ".join(
        f"select '{label}' as stage, cast({col} as bigint) as users from {_FUNNEL} "
        f"where {_last(_FUNNEL, 'z.browse_users > 0')}"
        for label, col in (
            ("浏览", "browse_users"),
            ("动作", "action_users"),
            ("加购", "cart_users"),
            ("下单", "order_users"),
        )
    ),
    "rpt_rfm_segments": "select user_segment, count(*) as user_count from ads_rfm_user_segmentation group by 1",
    "rpt_big_region_amount": "select big_region, cast(sum(order_total_amount) as double) as order_total_amount "
    f"from dws_trade_region_stats where {_last('dws_trade_region_stats', _SOLD_DAY)} group by 1",
    "rpt_user_top20": out(
        "(select *, rn_order as rn from ads_user_trade_ranking)",
        "rn:i user_nick_name user_level:i order_count:i order_total_amount:m payment_total_amount:m "
        "refund_total_amount:m",
        f"where rn_order <= 20 and {_last('dws_trade_user_stats', _SOLD_DAY)}",
    ),
    "rpt_region_top10": out(
        "ads_region_trade_overview",
        "region_name big_region order_count:i order_total_amount:m order_original_amount:m order_coupon_reduce:m",
        f"where rn <= 10 and {_last('dws_trade_region_stats', _SOLD_DAY)}",
    ),
    "rpt_rfm_user_top20": out(
        "(select * from ads_rfm_user_segmentation order by monetary desc, user_id limit 20)",
        f"{_RFM} user_segment",
    ),
    "rpt_brand_region_cross": "select b.brand_name, cast(b.order_total_amount as double) as brand_amount, "
    "r.region_name, cast(r.order_total_amount as double) as region_amount "
    f"from {_BRAND} b left join dws_trade_region_stats r on r.{_last('dws_trade_region_stats', _SOLD_DAY)} "
    f"where b.{_last(_BRAND, _SOLD_DAY)} order by b.order_total_amount desc, b.brand_id, r.order_total_amount desc, "
    "r.province_id limit 20",
    "audit_row_counts": _ALL,
    "src_snapshot_scan": "select cast(n_nationkey as bigint) as id, n_name as region_name, "
    "cast(n_regionkey as bigint) as parent_id from nation",
    # The newest line of each (order, line number), found by comparing whole lines.
    "upsert_latest_by_key": "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, "
    "strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') as l_shipdate, "
    "max(struct_pack(d := l_shipdate, p := l_partkey, s := l_suppkey, x := l_extendedprice)).p as l_partkey, "
    "max(struct_pack(d := l_shipdate, p := l_partkey, s := l_suppkey, x := l_extendedprice)).s as l_suppkey "
    "from lineitem group by 1, 2",
    # Orders as a change log of customers: a customer's last order counts, unless it deletes the customer.
    "src_cdc_fold": "select o_custkey as id, o_orderkey as order_id, o_orderstatus as trade_no, "
    "cast(cast(o_totalprice as decimal(18,2)) as double) as total_amount from orders o "
    "where o_orderkey = (select max(x.o_orderkey) from orders x where x.o_custkey = o.o_custkey) "
    "and o_orderstatus <> 'P'",
    # Every fifth record is broken, the next has a wrong user id, the next lacks its code.
    "src_json_tolerant": "select mid, case when event_id % 5 <> 1 then user_id end as user_id, "
    "case when event_id % 5 <> 2 then event_type end as err_code, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') as create_time, strftime(ts, '%Y-%m-%d') as dt "
    "from ev where event_id % 5 <> 0",
    # One event in thirty is broken, the next has a wrong user id; both are set aside.
    "stream_bad_rows_tolerated": "select case when event_id % 30 <> 0 then mid end as mid, "
    "case when event_id % 30 > 1 then user_id end as user_id, case when event_id % 30 <> 0 then event_type end as err_code, "
    "case when event_id % 30 <> 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') end as create_time, "
    "case event_id % 30 when 0 then 'no JSON object' when 1 then 'bad user_id' else '' end as reason from ev",
    # Late are rows of the second batch that lie more than a day before the newest of the first.
    "stream_watermark_option": "select setting, strftime(create_time, '%Y-%m-%d') as dt, "
    "count(*) filter (not late or setting = 'keep') as kept_rows, count(*) filter (late) as late_rows from "
    "(select create_time, dayofmonth(create_time) <= 15 and create_time < (select max(n.create_time) from log_page_view n "
    "where dayofmonth(n.create_time) > 15) - interval '1' day as late from log_page_view) v, "
    "(values ('keep'), ('drop')) s(setting) group by 1, 2",
    "stream_log_replayed": out("(select distinct * from ods_log_error)", _declared("log_error")),
    "rank_in_ranges": "select o_orderstatus, o_orderkey, o_totalprice, o_custkey, row_number() over (partition by "
    "o_orderstatus order by o_totalprice desc nulls last, o_orderkey) as rn_price, row_number() over (partition by "
    "o_orderstatus order by o_custkey desc nulls last, o_orderkey) as rn_cust from orders",
    "dws_retention_window": out(
        "dws_trade_user_stats",
        f"user_id:i dt:d {_USER_STATS}",
        "where dt between date '2024-01-21' and date '2024-02-23'",
    ),
    "latest_nonempty_day": "select strftime(max(dt), '%Y-%m-%d') as dt from dws_trade_region_stats "
    "where order_total_amount > 0",
}


@cache
def _needs(text: str) -> tuple[str, ...]:
    """Tables a statement uses, deepest first."""
    found: dict[str, None] = {}
    for word in _WORD.findall(text):
        if word in TABLES and word not in DRIVER_TABLES:
            for deep in _needs(TABLES[word]):
                found.setdefault(deep)
            found.setdefault(word)
    return tuple(found)


def sql(key: str) -> str:
    final = REPORTS[key] if key in REPORTS else out(*SPECS[key])
    tables = [t for t in _needs(final)]
    if not tables:
        return final
    ctes = ", ".join(f"{t} as ({TABLES[t]})" for t in tables)
    if final.startswith("with "):
        return f"with {ctes}, {final[5:]}"
    return f"with {ctes} {final}"


def all_sql() -> dict[str, str]:
    return {key: sql(key) for key in [*SPECS, *REPORTS]}
