"""Scans."""

from telemetry_lake.sources.raw import groups_condition, normalize, read_raw, where_groups, with_event_ts
from telemetry_lake.sources.tables import read_audit, read_clean, read_mark_log, read_quarantine

__all__ = [
    "groups_condition",
    "normalize",
    "read_audit",
    "read_clean",
    "read_mark_log",
    "read_quarantine",
    "read_raw",
    "where_groups",
    "with_event_ts",
]
