from shoplake.plans import ads, dim, dwd, dws, ods, reports
from shoplake.plans.warehouse import Warehouse

__all__ = ["Warehouse", "ads", "dim", "dwd", "dws", "ods", "reports"]
