"""Data-quality predicates: rules are data, compiled to one Column inside codegen."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RangeRule:
    """For one device type, the inclusive range a column must lie in."""

    device_type: str
    column: str
    low: float
    high: float


# --- fixed values: valid ranges per device type, required columns, duplicate key ---
SENSOR_RULES = (
    RangeRule("hvac_unit", "temperature_c", 18.0, 26.0),
    RangeRule("hvac_unit", "humidity_pct", 30.0, 60.0),
    RangeRule("motor", "vibration_mm_s", 0.5, 4.5),
    RangeRule("motor", "rpm", 800, 3600),
    RangeRule("cold_storage_unit", "temperature_c", -25.0, -10.0),
    RangeRule("cold_storage_unit", "door_open_count", 0, 5),
    RangeRule("smart_meter", "energy_kwh", 0.1, 15.0),
    RangeRule("smart_meter", "voltage", 215.0, 245.0),
)
REQUIRED_COLUMNS = ("device_id", "device_type", "event_ts", "battery_pct")
REPORT_KEY = ("device_id", "event_ts")
# --- end of fixed values ---


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions where an unknown counts as false, so a flag is never null."""
    return F.coalesce(reduce(lambda left, right: left | right, conditions, F.lit(False)), F.lit(False))


def null_flag(columns: Iterable[str]) -> Column:
    """True when any required column is null."""
    return any_of(F.col(c).isNull() for c in columns)


def range_flag(rules: Iterable[RangeRule], type_col: str = "device_type") -> Column:
    """True when a value breaks a rule of its device type.

    Bounds are inclusive. A null value and a device type without rules pass.
    """
    by_type: dict[str, list[RangeRule]] = {}
    for rule in rules:
        by_type.setdefault(rule.device_type, []).append(rule)
    return any_of(
        (F.col(type_col) == device_type)
        & any_of(~F.col(rule.column).between(rule.low, rule.high) for rule in of_type)
        for device_type, of_type in by_type.items()
    )
