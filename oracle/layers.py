"""Common table expressions, layer by layer; each names the ones it reads."""

from __future__ import annotations

from oracle.text import half_up, pct, units
from shoplake import schemas
from shoplake.sources.adapter import STATEMENTS

TABLES: dict[str, str] = {}

_TYPES = {"string": "varchar", "timestamp_ntz": "timestamp"}

for _name, _sql in STATEMENTS.items():
    _sql = _sql.replace("{JSON_K}", "json_extract_string(props, '$.k')").replace("{TS}", "timestamp")
    _sql = _sql.replace("{", "").replace("}", "")
    if _name in schemas.TABLES:
        # Declared columns that the adapter does not fill are NULL.
        _nulls = ", ".join(f"cast(null as {_TYPES.get(t, t)}) as {c}" for c, t in schemas.fields(_name).items())
        _sql = f"select * from ({_sql}) union all by name select {_nulls} where false"
    TABLES[_name] = _sql

_DAY = "strftime({}, '%Y-%m-%d') as dt"
for _t in (
    "order_info", "order_detail", "payment_info", "refund_info", "order_status_log", "cart_info", "coupon_use",
    "log_startup", "log_page_view", "log_action", "log_display", "log_error",
):
    TABLES[f"ods_{_t}"] = f"select *, {_DAY.format('get_time' if _t == 'coupon_use' else 'create_time')} from {_t}"

# --- dimensions ----------------------------------------------------------------
TABLES["dim_base_category"] = """
select leaf.id, leaf.category_name, leaf.level, leaf.parent_id,
       leaf.id as category3_id, leaf.category_name as category3_name,
       mid.id as category2_id, mid.category_name as category2_name,
       top.id as category1_id, top.category_name as category1_name, leaf.create_time, leaf.update_time
from base_category leaf
left join base_category mid on mid.id = leaf.parent_id
left join base_category top on top.id = mid.parent_id"""
_CAT = "c.category3_name, c.category2_id, c.category2_name, c.category1_id, c.category1_name"
TABLES["dim_spu_info"] = f"""
select p.id, p.spu_name, p.description, p.category3_id, {_CAT}, p.brand_id, b.brand_name, p.create_time, p.update_time
from spu_info p left join base_brand b on b.id = p.brand_id left join dim_base_category c on c.id = p.category3_id"""
TABLES["dim_sku_info"] = f"""
select k.id, k.sku_name, k.spu_id, p.spu_name, k.category3_id, {_CAT}, k.brand_id, b.brand_name, k.price,
       k.weight, k.img_url, k.is_sale, k.sku_attr, k.create_time, k.update_time
from sku_info k left join spu_info p on p.id = k.spu_id left join base_brand b on b.id = k.brand_id
left join dim_base_category c on c.id = k.category3_id"""

# --- facts -----------------------------------------------------------------------
_U = "u.nick_name as user_nick_name, u.user_level, u.age_range"
_UG = _U + ", u.gender"
_S = (
    "s.spu_id, s.spu_name, s.category3_id, s.category3_name, s.category2_id, s.category2_name, s.category1_id, "
    "s.category1_name, s.brand_id, s.brand_name"
)
_SN = "s.sku_name, s.spu_name, s.category3_name, s.category2_name, s.category1_name, s.brand_name"
_USER = "left join user_info u on u.id = f.user_id"
_SKU = "left join dim_sku_info s on s.id = f.sku_id"
TABLES["dwd_cart_info"] = f"select f.*, {_U}, {_S} from ods_cart_info f {_SKU} {_USER}"
TABLES["dwd_coupon_use"] = (
    f"select f.*, {_U}, c.coupon_name, c.full_amount, c.reduce_amount, c.use_condition "
    f"from ods_coupon_use f {_USER} "
    "left join coupon_info c on c.id = f.coupon_id"
)
TABLES["dwd_order_detail"] = (
    f"select f.*, {_S}, c.coupon_name, c.coupon_type from ods_order_detail f {_SKU} "
    "left join coupon_info c on c.id = f.coupon_id"
)
TABLES["dwd_order_info"] = (
    f"select f.*, {_UG}, r.region_name, r.big_region from ods_order_info f {_USER} "
    "left join base_region r on r.id = f.province_id"
)
TABLES["dwd_order_status_log"] = "select * from ods_order_status_log"
for _t in ("payment_info", "refund_info"):
    TABLES[f"dwd_{_t}"] = f"select f.*, {_U} from ods_{_t} f {_USER}"
for _t in ("log_startup", "log_page_view", "log_error"):
    TABLES[f"dwd_{_t}"] = f"select f.*, {_UG} from ods_{_t} f {_USER}"
TABLES["dwd_log_action"] = (
    f"select f.*, {_UG}, {_SN} from ods_log_action f {_USER} left join dim_sku_info s "
    "on f.item_type = 'sku' and s.id = try_cast(f.item_id as bigint)"
)
TABLES["dwd_log_display"] = (
    f"select f.*, {_UG}, {_SN} from (select *, try_cast(unnest(string_split(item_ids, ',')) as bigint) as sku_id "
    f"from ods_log_display) f {_USER} {_SKU}"
)

# --- aggregates ------------------------------------------------------------------
_D = "cast(f.dt as date) as dt"
TABLES["dws_trade_user_stats"] = """
select coalesce(o.user_id, p.user_id, r.user_id, c.user_id) as user_id,
       coalesce(o.dt, p.dt, r.dt, c.dt) as dt,
       coalesce(o.nick, p.nick, r.nick, c.nick) as user_nick_name,
       coalesce(o.lvl, p.lvl, r.lvl, c.lvl) as user_level,
       coalesce(o.age, p.age, r.age, c.age) as age_range, o.gender,
       coalesce(o.n, 0) as order_count, coalesce(o.total, 0) as order_total_amount,
       coalesce(o.original, 0) as order_original_amount, coalesce(o.reduced, 0) as order_coupon_reduce,
       coalesce(p.n, 0) as payment_count, coalesce(p.total, 0) as payment_total_amount,
       coalesce(r.n, 0) as refund_count, coalesce(r.total, 0) as refund_total_amount,
       coalesce(r.units, 0) as refund_num, coalesce(c.n, 0) as coupon_count,
       coalesce(c.total, 0) as coupon_reduce_amount
from (select user_id, cast(dt as date) as dt, max(user_nick_name) as nick, max(user_level) as lvl,
             max(age_range) as age, max(gender) as gender, count(*) as n, sum(total_amount) as total,
             sum(original_total_amount) as original, sum(coupon_reduce_amount) as reduced
      from dwd_order_info where user_id is not null group by 1, 2) o
full join (select user_id, cast(dt as date) as dt, max(user_nick_name) as nick, max(user_level) as lvl,
             max(age_range) as age, count(*) as n, sum(total_amount) as total
      from dwd_payment_info where user_id is not null group by 1, 2) p
  on p.user_id = o.user_id and p.dt = o.dt
full join (select user_id, cast(dt as date) as dt, max(user_nick_name) as nick, max(user_level) as lvl,
             max(age_range) as age, count(*) as n, sum(refund_amount) as total, sum(refund_num) as units
      from dwd_refund_info where user_id is not null group by 1, 2) r
  on r.user_id = coalesce(o.user_id, p.user_id) and r.dt = coalesce(o.dt, p.dt)
full join (select user_id, cast(dt as date) as dt, max(user_nick_name) as nick, max(user_level) as lvl,
             max(age_range) as age, count(*) as n, sum(coupon_reduce_amount) as total
      from dwd_coupon_use where user_id is not null group by 1, 2) c
  on c.user_id = coalesce(o.user_id, p.user_id, r.user_id) and c.dt = coalesce(o.dt, p.dt, r.dt)"""

_SKU_ATTRS = (
    "sku_name spu_id spu_name category3_id category3_name category2_id category2_name category1_id "
    "category1_name brand_id brand_name"
).split()
TABLES["dws_trade_sku_stats"] = f"""
with line as (select sku_id, dt, {', '.join(_SKU_ATTRS)}, sku_num as units, split_total_amount as amount,
                     split_coupon_amount as coupon, split_activity_amount as activity, true as is_order
              from dwd_order_detail
              union all
              select sku_id, dt, {', '.join(_SKU_ATTRS)}, sku_num, null, null, null, false from dwd_cart_info)
select sku_id, cast(dt as date) as dt, {', '.join(f'max({a}) as {a}' for a in _SKU_ATTRS)},
       count(*) filter (is_order) as order_count, coalesce(sum(units) filter (is_order), 0) as order_sku_num,
       coalesce(sum(amount), 0) as order_total_amount, coalesce(sum(coupon), 0) as order_coupon_reduce,
       coalesce(sum(activity), 0) as order_activity_reduce, count(*) filter (not is_order) as cart_count,
       coalesce(sum(units) filter (not is_order), 0) as cart_sku_num
from line where sku_id is not null and dt is not null group by sku_id, dt"""
TABLES["dws_log_page_stats"] = f"""
select page_id, {_D}, max(page_name) as page_name, count(*) as pv, count(distinct user_id) as uv,
       sum(coalesce(during_time, 0)) as total_during_time, sum(coalesce(jump_count, 0)) as total_jump_count
from dwd_log_page_view f where page_id is not null and f.dt is not null group by page_id, 2"""
TABLES["dws_log_sku_exposure_stats"] = f"""
select sku_id, {_D}, max(sku_name) as sku_name, max(spu_name) as spu_name, max(category3_name) as category3_name,
       max(category2_name) as category2_name, max(category1_name) as category1_name, max(brand_name) as brand_name,
       count(*) as exposure_count, count(distinct user_id) as exposure_user_count
from dwd_log_display f where sku_id is not null group by sku_id, 2"""
TABLES["dws_log_user_action_stats"] = """
with seen as (select user_id, dt, user_nick_name, user_level, age_range, gender, 'startup' as kind from dwd_log_startup
              union all select user_id, dt, user_nick_name, user_level, age_range, gender, 'page' from dwd_log_page_view
              union all select user_id, dt, user_nick_name, user_level, age_range, gender, 'action' from dwd_log_action
              union all select user_id, dt, user_nick_name, user_level, age_range, gender, 'show' from dwd_log_display
              union all select user_id, dt, user_nick_name, user_level, age_range, gender, 'error' from dwd_log_error)
select user_id, cast(dt as date) as dt, max(user_nick_name) as user_nick_name, max(user_level) as user_level,
       max(age_range) as age_range, max(gender) as gender,
       count(*) filter (kind = 'startup') as startup_count, count(*) filter (kind = 'page') as page_view_count,
       count(*) filter (kind = 'action') as action_count, count(*) filter (kind = 'show') as exposure_count,
       count(*) filter (kind = 'error') as error_count
from seen where user_id is not null and dt is not null group by user_id, dt"""
TABLES["dws_trade_region_stats"] = f"""
select province_id, {_D}, max(region_name) as region_name, max(big_region) as big_region, count(*) as order_count,
       sum(total_amount) as order_total_amount, sum(original_total_amount) as order_original_amount,
       sum(coupon_reduce_amount) as order_coupon_reduce
from dwd_order_info f group by province_id, 2"""
TABLES["dws_trade_coupon_stats"] = f"""
select coupon_id, {_D}, max(coupon_name) as coupon_name, max(coupon_type) as coupon_type,
       max(full_amount) as full_amount, max(reduce_amount) as reduce_amount,
       max(use_condition) as use_condition, count(*) as coupon_count, sum(coupon_reduce_amount) as coupon_reduce_amount
from dwd_coupon_use f group by coupon_id, 2"""
TABLES["dws_daily_active_users"] = f"""
select {_D}, user_id, min(create_time) as first_action_time, count(*) as page_view_count
from dwd_log_page_view f where user_id is not null group by 1, 2"""
TABLES["dws_daily_order_users"] = f"""
select {_D}, user_id, min(create_time) as first_order_time, count(*) as order_count, sum(total_amount) as total_amount
from dwd_order_info f where user_id is not null group by 1, 2"""
TABLES["dws_page_transition_stats"] = f"""
select {_D}, last_page_id, page_id, count(*) as transition_count, count(distinct user_id) as transition_users,
       count(distinct mid) as transition_sessions
from dwd_log_page_view f where coalesce(last_page_id, '') <> '' group by 1, 2, 3"""
TABLES["dws_gmv_hourly_trend"] = f"""
select {_D}, extract(hour from create_time) as hour, count(*) as order_count, count(distinct user_id) as order_users,
       sum(total_amount) as gmv, sum(original_total_amount) as original_amount,
       sum(coupon_reduce_amount) as coupon_reduce
from dwd_order_info f where user_id is not null group by 1, 2"""
TABLES["dws_log_error_stats"] = f"""
select {_D}, err_code, max(err_name) as err_name, count(*) as error_count,
       count(distinct user_id) as error_user_count, count(distinct mid) as error_device_count
from dwd_log_error f group by 1, 2"""

# --- views -----------------------------------------------------------------------
TABLES["ads_daily_trade_overview"] = """
select dt, sum(order_count) as total_order_count, sum(order_total_amount) as total_order_amount,
       sum(order_original_amount) as total_original_amount, sum(order_coupon_reduce) as total_coupon_reduce,
       sum(payment_count) as total_payment_count, sum(payment_total_amount) as total_payment_amount,
       sum(refund_count) as total_refund_count, sum(refund_total_amount) as total_refund_amount,
       sum(coupon_count) as total_coupon_count, sum(coupon_reduce_amount) as total_coupon_reduce_amount
from dws_trade_user_stats group by dt"""
_RANK = "row_number() over (partition by dt order by {} desc, {}) as {}"
TABLES["ads_user_trade_ranking"] = (
    f"select *, {_RANK.format('order_total_amount', 'user_id', 'rn_order')}, "
    f"{_RANK.format('payment_total_amount', 'user_id', 'rn_payment')} from dws_trade_user_stats"
)
TABLES["ads_sku_sales_ranking"] = (
    f"select *, {_RANK.format('order_total_amount', 'sku_id', 'rn_amount')}, "
    f"{_RANK.format('order_sku_num', 'sku_id', 'rn_qty')} from dws_trade_sku_stats"
)
TABLES["ads_region_trade_overview"] = (
    f"select *, {_RANK.format('order_total_amount', 'province_id nulls first', 'rn')} from dws_trade_region_stats"
)
_SALES = "sum(order_count) as order_count, sum(order_sku_num) as order_sku_num, sum(order_total_amount) as order_total_amount"
TABLES["ads_category1_sales_summary"] = f"""
select dt, category1_id, category1_name, count(distinct sku_id) as sku_count, {_SALES},
       sum(order_coupon_reduce) as order_coupon_reduce, sum(order_activity_reduce) as order_activity_reduce,
       sum(cart_count) as cart_count, sum(cart_sku_num) as cart_sku_num
from dws_trade_sku_stats group by all"""
TABLES["ads_brand_sales_summary"] = f"""
select dt, brand_id, brand_name, count(distinct sku_id) as sku_count, {_SALES}, sum(cart_count) as cart_count
from dws_trade_sku_stats group by all"""
TABLES["ads_log_traffic_overview"] = """
select dt, sum(pv) as total_pv, sum(uv) as total_uv, sum(total_during_time) as total_during_time,
       sum(total_jump_count) as total_jump_count,
       cast(sum(total_during_time) as double) / cast(sum(pv) as double) as avg_during_time
from dws_log_page_stats group by dt"""
TABLES["ads_log_page_ranking"] = (
    "select *, cast(total_during_time as double) / cast(pv as double) as avg_during_time, "
    f"{_RANK.format('pv', 'page_id', 'rn_pv')}, {_RANK.format('uv', 'page_id', 'rn_uv')} from dws_log_page_stats"
)
TABLES["ads_log_sku_exposure_ranking"] = (
    f"select *, {_RANK.format('exposure_count', 'sku_id', 'rn_exposure')}, "
    f"{_RANK.format('exposure_user_count', 'sku_id', 'rn_exposure_user')} from dws_log_sku_exposure_stats"
)
TABLES["ads_log_user_activity_ranking"] = (
    f"select *, {_RANK.format('total_action_count', 'user_id', 'rn')} from (select *, startup_count + page_view_count "
    "+ action_count + exposure_count as total_action_count from dws_log_user_action_stats)"
)
TABLES["ads_log_funnel_analysis"] = """
with browse as (select distinct user_id, dt from dwd_log_page_view where starts_with(page_id, 'sku')),
     act as (select distinct user_id, dt from dwd_log_action where item_type = 'sku'),
     cart as (select distinct user_id, dt from dwd_cart_info),
     ordered as (select distinct user_id, dt from dwd_order_info),
     anyone as (select * from browse union select * from act union select * from cart union select * from ordered)
select cast(a.dt as date) as dt, count(a.user_id) as browse_users, count(x.user_id) as action_users,
       count(c.user_id) as cart_users, count(o.user_id) as order_users
from anyone a
left join act x on x.user_id = a.user_id and x.dt = a.dt
left join cart c on c.user_id = a.user_id and c.dt = a.dt
left join ordered o on o.user_id = a.user_id and o.dt = a.dt
where a.user_id is not null group by 1"""
TABLES["ads_user_first_active"] = (
    "select user_id, min(dt) as first_active_dt from dws_daily_active_users group by user_id"
)
TABLES["ads_user_first_order"] = "select user_id, min(dt) as first_order_dt from dws_daily_order_users group by user_id"


def _retention(first: str, first_day: str, daily: str, new: str, kept: str, rate: str) -> str:
    back = (
        "(select count(distinct a.user_id) from {d} a join {f} b on a.user_id = b.user_id "
        "where b.{c} = n.day0 and a.dt = n.day0 + {g})"
    )
    counts = ", ".join(f"{back.format(d=daily, f=first, c=first_day, g=g)} as {kept.format(g)}" for g in (1, 7, 30))
    rates = ", ".join(f"{half_up(kept.format(g) + ' * 100', new, 2)} as {rate.format(g)}" for g in (1, 7, 30))
    return (
        f"select *, {rates} from (select n.day0 as dt, n.users as {new}, {counts} from "
        f"(select {first_day} as day0, count(*) as users from {first} group by 1) n)"
    )


TABLES["ads_user_browse_retention"] = _retention(
    "ads_user_first_active", "first_active_dt", "dws_daily_active_users", "new_users", "day{}_retained",
    "day{}_retention_rate",
)
TABLES["ads_user_purchase_retention"] = _retention(
    "ads_user_first_order", "first_order_dt", "dws_daily_order_users", "new_buyers", "day{}_repurchase",
    "day{}_repurchase_rate",
)
TABLES["ads_page_transition_matrix"] = """
select dt, last_page_id as from_page, page_id as to_page, transition_count, transition_users, transition_sessions,
       cast(coalesce(page_id, '') = '' as int) as is_bounce,
       row_number() over (partition by dt order by transition_count desc, last_page_id, page_id nulls first) as rn
from dws_page_transition_stats"""
TABLES["ads_user_path_top10"] = """
select dt, from_page || ' -> ' || to_page as path, transition_count, transition_users, rn
from ads_page_transition_matrix where rn <= 10"""
TABLES["ads_page_outflow_top3"] = """
select * from (
    select dt, last_page_id as from_page, page_id as to_page, transition_count, transition_users,
           row_number() over (partition by dt, last_page_id order by transition_count desc, page_id nulls first) as rn
    from dws_page_transition_stats) where rn <= 3"""
TABLES["ads_rfm_user_segmentation"] = """
with per_user as (
    select user_id, max(user_nick_name) as user_nick_name, max(user_level) as user_level,
           date_diff('day', max(dt), date '2024-03-01') as recency, sum(order_count) as frequency,
           sum(order_total_amount) as monetary
    from dws_trade_user_stats where order_count > 0 group by user_id),
n as (select count(*) as users, sum(recency) as r, sum(frequency) as f, sum(monetary) as m from per_user),
scored as (select p.*, cast(p.recency * n.users <= n.r as int) as r_score,
                  cast(p.frequency * n.users >= n.f as int) as f_score,
                  cast(p.monetary * n.users >= n.m as int) as m_score from per_user p, n)
select *, case r_score * 100 + f_score * 10 + m_score
    when 111 then '高价值用户' when 11 then '重点保持用户' when 101 then '重点发展用户' when 1 then '重点挽留用户'
    when 110 then '一般价值用户' when 10 then '一般保持用户' when 100 then '一般发展用户' else '流失预警用户' end as user_segment
from scored"""
TABLES["ads_rfm_segment_summary"] = f"""
select user_segment, user_count, total_orders, total_amount,
       {half_up('user_count * 100', '(select sum(s.user_count) from segment s)', 2)} as user_pct,
       {half_up(units('total_amount') + ' * 100', '(select ' + units('sum(s.total_amount)') + ' from segment s)', 2)}
           as amount_pct,
       {half_up('days', 'user_count', 1)} as avg_recency, {half_up('total_orders', 'user_count', 1)} as avg_frequency,
       {half_up(units('total_amount'), 'user_count * 10000', 2)} as avg_monetary
from (select user_segment, count(*) as user_count, sum(frequency) as total_orders, sum(monetary) as total_amount,
             sum(recency) as days from ads_rfm_user_segmentation group by 1)"""
TABLES["segment"] = (
    "select user_segment, count(*) as user_count, sum(monetary) as total_amount from ads_rfm_user_segmentation group by 1"
)
TABLES["ads_gmv_realtime_dashboard"] = f"""
select * rename (total_order_amount as total_gmv),
       {pct('total_payment_count', 'total_order_count')} as payment_conversion_rate,
       {pct('total_refund_count', 'total_order_count')} as refund_rate,
       (case when total_order_count > 0 then {half_up(units('total_order_amount'), 'total_order_count * 10000', 2)}
             else 0.0::double end) as avg_order_amount,
       {pct(units('total_coupon_reduce'), units('total_original_amount'))} as coupon_usage_rate
from ads_daily_trade_overview"""
_GMV = units("gmv")
_PREV = units("coalesce(lag(gmv) over (partition by dt order by hour), 0)")
TABLES["ads_gmv_hourly_trend"] = f"""
select *, {pct('cents - before', 'before')} as gmv_hourly_growth_rate,
       sum(gmv) over (partition by dt order by hour rows unbounded preceding) as cumulative_gmv
from (select *, {_GMV} as cents, {_PREV} as before from dws_gmv_hourly_trend)"""
_WEEK = "(partition by {} order by dt rows between 6 preceding and current row)"


def _week(col: str, key: str, digits: int, money: bool = False) -> str:
    w = _WEEK.format(key)
    total = units(f"sum({col}) over {w}") if money else f"sum({col}) over {w}"
    return half_up(total, f"(count({col}) over {w}){' * 10000' if money else ''}", digits)


TABLES["ads_sku_sales_trend"] = f"""
select *, {pct('order_count - before', 'before')} as daily_growth_rate
from (select *, {_week('order_count', 'sku_id', 1)} as avg_7d_order_count,
             {_week('order_total_amount', 'sku_id', 2, True)} as avg_7d_amount,
             {_week('cart_count', 'sku_id', 1)} as avg_7d_cart_count,
             coalesce(lag(order_count) over (partition by sku_id order by dt), 0) as before
      from dws_trade_sku_stats)"""
TABLES["ads_sku_sales_anomaly"] = f"""
select *, {pct('order_count * 10 - cast(round(avg_7d_order_count * 10) as bigint)',
               'cast(round(avg_7d_order_count * 10) as bigint)')} as deviation_rate,
       case when order_count > avg_7d_order_count then '销量激增' else '销量下滑' end as anomaly_type
from ads_sku_sales_trend
where avg_7d_order_count > 0 and (order_count > avg_7d_order_count * 1.3::double or order_count < avg_7d_order_count * 0.7::double)"""
TABLES["ads_category_sales_trend"] = f"""
select *, {_week('total_order_count', 'category1_name', 1)} as avg_7d_order_count,
       {_week('total_amount', 'category1_name', 2, True)} as avg_7d_amount,
       {half_up(units('total_amount') + ' * 100', units('sum(total_amount) over (partition by dt)'), 2)} as amount_pct
from (select dt, category1_name, sum(order_count) as total_order_count, sum(order_sku_num) as total_sku_num,
             sum(order_total_amount) as total_amount, sum(cart_count) as total_cart_count
      from dws_trade_sku_stats group by 1, 2)"""
