from shoplake.operators.audit import audit_row_counts
from shoplake.operators.changelog import affected_groups, apply_changes, change_rows, latest_by_key, live_rows
from shoplake.operators.enrich import explode_ids, flatten_tree, lookup_join
from shoplake.operators.measures import union_measures
from shoplake.operators.models import funnel, retention, rfm
from shoplake.operators.ranking import rank_by, top_by
from shoplake.operators.windows import (
    growth_vs_prev,
    latest_nonempty_day,
    retain_window,
    running_sum,
    share_of_total,
    trailing_mean,
)

__all__ = [
    "affected_groups",
    "apply_changes",
    "audit_row_counts",
    "change_rows",
    "explode_ids",
    "flatten_tree",
    "funnel",
    "growth_vs_prev",
    "latest_by_key",
    "latest_nonempty_day",
    "live_rows",
    "lookup_join",
    "rank_by",
    "retain_window",
    "retention",
    "rfm",
    "running_sum",
    "share_of_total",
    "top_by",
    "trailing_mean",
    "union_measures",
]
