"""Which function builds which table from which tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.logger import PySparkLogger
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.plans import ads, dim, dwd, dws, ods, reports

Builder = tuple[Callable[..., DataFrame], tuple[str, ...]]

_USER, _SKU = "dim.user_info", "dim.sku_info"
_NO_COLUMN = ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION")


def _rules() -> dict[str, Builder]:
    rules: dict[str, Builder] = {}
    for t in schemas.TABLES:
        rules[f"ods.{t}"] = (partial(ods.load, t), (f"raw.{t}",))
    for t in ("base_brand", "base_dic", "base_region", "coupon_info", "user_info"):
        rules[f"dim.{t}"] = (partial(dim.copy, t), (f"ods.{t}",))
    rules["dim.base_category"] = (dim.base_category, ("ods.base_category",))
    rules["dim.spu_info"] = (dim.spu_info, ("ods.spu_info", "ods.base_brand", "dim.base_category"))
    rules["dim.sku_info"] = (dim.sku_info, ("ods.sku_info", "ods.spu_info", "ods.base_brand", "dim.base_category"))

    for t, dims in {
        "cart_info": (_SKU, _USER),
        "coupon_use": (_USER, "dim.coupon_info"),
        "order_detail": (_SKU, "dim.coupon_info"),
        "order_info": (_USER, "dim.base_region"),
        "order_status_log": (),
        "payment_info": (_USER,),
        "refund_info": (_USER,),
        "log_startup": (_USER,),
        "log_page_view": (_USER,),
        "log_action": (_USER, _SKU),
        "log_display": (_USER, _SKU),
        "log_error": (_USER,),
    }.items():
        rules[f"dwd.{t}"] = (getattr(dwd, t), (f"ods.{t}", *dims))

    for t, inputs in {
        "trade_user_stats": ("order_info", "payment_info", "refund_info", "coupon_use"),
        "trade_sku_stats": ("order_detail", "cart_info"),
        "log_page_stats": ("log_page_view",),
        "log_sku_exposure_stats": ("log_display",),
        "log_user_action_stats": ("log_startup", "log_page_view", "log_action", "log_display", "log_error"),
        "trade_region_stats": ("order_info",),
        "trade_coupon_stats": ("coupon_use",),
        "daily_active_users": ("log_page_view",),
        "daily_order_users": ("order_info",),
        "page_transition_stats": ("log_page_view",),
        "gmv_hourly_trend": ("order_info",),
        "log_error_stats": ("log_error",),
    }.items():
        rules[f"dws.{t}"] = (getattr(dws, t), tuple(f"dwd.{i}" for i in inputs))

    for view, inputs in {
        "daily_trade_overview": ("dws.trade_user_stats",),
        "user_trade_ranking": ("dws.trade_user_stats",),
        "sku_sales_ranking": ("dws.trade_sku_stats",),
        "region_trade_overview": ("dws.trade_region_stats",),
        "coupon_analysis": ("dws.trade_coupon_stats",),
        "category1_sales_summary": ("dws.trade_sku_stats",),
        "brand_sales_summary": ("dws.trade_sku_stats",),
        "log_traffic_overview": ("dws.log_page_stats",),
        "log_page_ranking": ("dws.log_page_stats",),
        "log_sku_exposure_ranking": ("dws.log_sku_exposure_stats",),
        "log_user_activity_ranking": ("dws.log_user_action_stats",),
        "log_error_analysis": ("dws.log_error_stats",),
        "log_funnel_analysis": ("dwd.log_page_view", "dwd.log_action", "dwd.cart_info", "dwd.order_info"),
        "user_first_active": ("dws.daily_active_users",),
        "user_first_order": ("dws.daily_order_users",),
        "user_browse_retention": ("dws.daily_active_users",),
        "user_purchase_retention": ("dws.daily_order_users",),
        "page_transition_matrix": ("dws.page_transition_stats",),
        "user_path_top10": ("dws.page_transition_stats",),
        "page_outflow_top3": ("dws.page_transition_stats",),
        "rfm_segment_summary": ("ads.rfm_user_segmentation",),
        "gmv_realtime_dashboard": ("dws.trade_user_stats",),
        "gmv_hourly_trend": ("dws.gmv_hourly_trend",),
        "sku_sales_trend": ("dws.trade_sku_stats",),
        "sku_sales_anomaly": ("ads.sku_sales_trend",),
        "category_sales_trend": ("dws.trade_sku_stats",),
    }.items():
        rules[f"ads.{view}"] = (getattr(ads, view), inputs)

    for name, fn, inputs in (
        ("trade_kpis", reports.trade_kpis, ("ads.gmv_realtime_dashboard",)),
        ("trade_trend_30d", reports.trade_trend, ("ads.daily_trade_overview",)),
        ("daily_trade_detail", reports.daily_trade_detail, ("ads.daily_trade_overview",)),
        ("brand_top15", reports.brand_top, ("ads.brand_sales_summary",)),
        ("brand_detail", reports.brand_detail, ("ads.brand_sales_summary",)),
        ("category1_share", reports.category1_share, ("ads.category1_sales_summary",)),
        ("sku_top20_amount", reports.sku_top, ("dws.trade_sku_stats",)),
        ("sku_top20_qty", partial(reports.sku_top, measure="order_sku_num"), ("dws.trade_sku_stats",)),
        ("traffic_kpis", reports.traffic_kpis, ("ads.log_traffic_overview",)),
        ("traffic_trend_30d", reports.traffic_trend, ("ads.log_traffic_overview",)),
        ("conversion_funnel", reports.conversion_funnel, ("ads.log_funnel_analysis",)),
        ("rfm_segments", reports.rfm_segments, ("ads.rfm_user_segmentation",)),
        ("big_region_amount", reports.big_region_amount, ("dws.trade_region_stats",)),
        ("user_top20", reports.user_top, ("dws.trade_user_stats",)),
        ("region_top10", reports.region_top, ("dws.trade_region_stats",)),
        ("rfm_user_top20", reports.rfm_user_top, ("ads.rfm_user_segmentation",)),
        ("brand_region_cross", reports.brand_region_cross, ("ads.brand_sales_summary", "dws.trade_region_stats")),
    ):
        rules[f"rpt.{name}"] = (fn, inputs)
    return rules


RULES = _rules()

# Aggregates that are recomputed as a whole on a schedule; the others follow the change streams.
REFRESHED = (
    "trade_region_stats",
    "trade_coupon_stats",
    "daily_active_users",
    "daily_order_users",
    "page_transition_stats",
    "gmv_hourly_trend",
    "log_error_stats",
)


class Warehouse:
    """Lazy access to every table and report by name, such as ``ads.gmv_realtime_dashboard``.

    ``stored`` returns the DataFrame of a table that exists already, or None; what
    is not stored is computed from the layer below.  ``as_of`` is the day
    recency counts from and ``today`` the day of the today report; both default
    to the current date.
    """

    def __init__(
        self,
        stored: Callable[[str], DataFrame | None],
        as_of: date | None = None,
        today: date | None = None,
    ) -> None:
        self._stored = stored
        self._as_of: date | Column = as_of or F.current_date()
        self._today: date | Column = today or F.current_date()
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            found = self._stored(name)
            self._known[name] = self._build(name) if found is None else found
        return self._known[name]

    def _build(self, name: str) -> DataFrame:
        if name == "ads.rfm_user_segmentation":
            return self._leanest(partial(ads.rfm_user_segmentation, as_of=self._as_of), ("dws.trade_user_stats",))
        if name == "ads.gmv_today_summary":
            return ads.gmv_today_summary(self["ads.gmv_realtime_dashboard"], self._today)
        if name not in RULES:
            raise KeyError(name)
        build, inputs = RULES[name]
        table = name.removeprefix("dws.")
        if table not in dws.LATE or table == name:
            return self._leanest(build, inputs)
        if self._computed(inputs):
            return dws.with_late(self._measures(table), dws.LATE[table], self[dws.LATE[table].dim])
        return build(*[self[i] for i in inputs])

    def _computed(self, facts: tuple[str, ...]) -> bool:
        """None of the facts is stored: stored ones keep the dimension values of their time, computed ones need not."""
        return all(self._stored(f) is None for f in facts)

    def _measures(self, table: str) -> DataFrame:
        """An aggregate of raw facts, its late attributes NULL."""
        name = f"lean.{table}"
        if name not in self._known:
            build, facts = RULES[f"dws.{table}"]
            raw = [self._lean(f) for f in facts]
            self._known[name] = dws.measures_of_raw(build, dws.LATE[table], raw)
        return self._known[name]

    def _lean(self, name: str) -> DataFrame | None:
        """A table that has to be computed, without the columns it looks up; None if it has no such form."""
        layer, _, table = name.partition(".")
        if self._stored(name) is not None:
            return None
        if layer == "dwd":
            return dwd.bare(table, self[f"ods.{table}"])
        if layer == "dws" and table in dws.LATE and self._computed(RULES[name][1]):
            return self._measures(table).drop(*dws.LATE[table].cols)
        return None

    def _leanest(self, build: Callable[..., DataFrame], inputs: tuple[str, ...]) -> DataFrame:
        """The result from inputs without looked-up columns where it reads none of these, so that nothing is joined for nothing.

        It reads none if it can be built without them and has the same columns.
        """
        full = build(*[self[i] for i in inputs])
        lean = {i: self._lean(i) for i in inputs}
        if all(df is None for df in lean.values()):
            return full
        # A column that is not there is an answer here, not an error to be logged.
        log = PySparkLogger.getLogger("DataFrameQueryContextLogger")
        was, log.disabled = log.disabled, True
        try:
            bare = build(*[self[i] if lean[i] is None else lean[i] for i in inputs])
            return bare if bare.dtypes == full.dtypes else full
        except AnalysisException as missing:
            if missing.getCondition() not in _NO_COLUMN:
                raise
            return full
        finally:
            log.disabled = was

    def register_views(self, *names: str) -> None:
        """Temporary views named ``layer_table`` for SQL users."""
        for name in names:
            self[name].createOrReplaceTempView(name.replace(".", "_"))
