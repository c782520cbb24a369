"""Column-level building blocks."""

from telemetry_lake.functions.rules import (
    REPORT_KEY,
    REQUIRED_COLUMNS,
    SENSOR_RULES,
    RangeRule,
    any_of,
    null_flag,
    range_flag,
)
from telemetry_lake.functions.times import (
    date_text,
    event_time,
    event_time_text,
    hour_text,
    in_dates,
    key_number,
    key_text,
    mark_key,
    two_digits,
)

__all__ = [
    "REPORT_KEY",
    "REQUIRED_COLUMNS",
    "SENSOR_RULES",
    "RangeRule",
    "any_of",
    "date_text",
    "event_time",
    "event_time_text",
    "hour_text",
    "in_dates",
    "key_number",
    "key_text",
    "mark_key",
    "null_flag",
    "range_flag",
    "two_digits",
]
