from shoplake.sources.adapter import adapted
from shoplake.sources.changes import cdc_records, cdc_stream, change_stream
from shoplake.sources.logs import json_log_stream, parse_log
from shoplake.sources.snapshot import jdbc_options, snapshot_scan

__all__ = [
    "adapted",
    "cdc_records",
    "cdc_stream",
    "change_stream",
    "jdbc_options",
    "json_log_stream",
    "parse_log",
    "snapshot_scan",
]
