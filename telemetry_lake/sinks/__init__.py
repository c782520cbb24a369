"""Sinks."""

from telemetry_lake.sinks.readings import land_raw, settle_landing, write_clean, write_quarantine
from telemetry_lake.sinks.results import append_audit, append_devices, append_marks, range_replace, replaced_range

__all__ = [
    "append_audit",
    "append_devices",
    "append_marks",
    "land_raw",
    "range_replace",
    "replaced_range",
    "settle_landing",
    "write_clean",
    "write_quarantine",
]
