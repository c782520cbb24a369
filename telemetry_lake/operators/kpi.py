"""Daily KPI tables.

All aggregates are algebraic (count, sum, min, max, variance), so Spark combines them
before the shuffle and a hot group costs one row per task. `dt` is compared as text and
reaches the scan as a partition filter, the device type as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.times import in_dates

MEASURE = "decimal(10,2)"
RATE = "decimal(5,2)"


def mean(column: str) -> Column:
    """Average; exact sums for decimals, null when every value is null."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def rounded(value: Column) -> Column:
    """Two places; null where the value does not fit, so that one reading cannot stop a run.

    Doubles added in another order differ in their last digits, which would turn a half up
    one time and down the next; the ninth place settles that first.
    """
    return F.round(F.round(value, 9), 2).try_cast(MEASURE)


# How each aggregate of a KPI is computed and stored.
AGGREGATES = {
    "avg": lambda c: rounded(mean(c)),
    "sum": lambda c: rounded(F.sum(c)),
    "total": lambda c: F.round(F.sum(c)).try_cast("bigint"),
    "min": lambda c: F.min(c).try_cast(MEASURE),
    "max": lambda c: F.max(c).try_cast(MEASURE),
    "stddev": lambda c: rounded(F.stddev_samp(F.col(c).cast("double"))),
}


@dataclass(frozen=True)
class DailyKpi:
    """Daily aggregates of one device type: `measures` are (output, aggregate, column)."""

    table: str
    device_type: str
    keys: Sequence[str]
    measures: Sequence[tuple[str, str, str]]


MOTOR_VIBRATION = DailyKpi(
    "daily_motor_vibration_trend",
    "motor",
    ("device_id", "facility_id"),
    (("avg_vibration_mm_s", "avg", "vibration_mm_s"), ("max_vibration_mm_s", "max", "vibration_mm_s")),
)
COLD_STORAGE = DailyKpi(
    "daily_cold_storage_risk",
    "cold_storage_unit",
    ("device_id", "facility_id"),
    (("avg_temperature_c", "avg", "temperature_c"), ("total_door_open_count", "total", "door_open_count")),
)
HVAC_STABILITY = DailyKpi(
    "daily_hvac_stability",
    "hvac_unit",
    ("device_id", "facility_id", "zone"),
    (("avg_temperature_c", "avg", "temperature_c"), ("stddev_temperature_c", "stddev", "temperature_c")),
)
ENERGY_VOLTAGE = DailyKpi(
    "daily_energy_voltage_summary",
    "smart_meter",
    ("device_id", "facility_id"),
    (
        ("total_energy_kwh", "sum", "energy_kwh"),
        ("avg_voltage", "avg", "voltage"),
        ("min_voltage", "min", "voltage"),
    ),
)
DEVICE_KPIS = (MOTOR_VIBRATION, COLD_STORAGE, HVAC_STABILITY, ENERGY_VOLTAGE)
DEVICE_HEALTH_TABLE = "daily_device_health_summary"


def daily_kpi(clean: DataFrame, spec: DailyKpi, start: str, end: str) -> DataFrame:
    """One row per date and key of `spec`; rows with a null measure still count."""
    measures = [AGGREGATES[how](column).alias(name) for name, how, column in spec.measures]
    return (
        clean.where((F.col("device_type") == spec.device_type) & in_dates(start, end))
        .groupBy("dt", *spec.keys)
        .agg(*measures, F.count("*").alias("reading_count"))
        .withColumn("dt", F.col("dt").cast("date"))
    )


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FULL OUTER equi-join with coalesced keys; a null key matches nothing."""
    return left.join(right, list(keys), "full")


def device_health(clean: DataFrame, quarantine: DataFrame, start: str, end: str) -> DataFrame:
    """Good, bad and total readings, failure rate and battery per date, type and facility.

    Both sides are aggregated before the join, which then works on a few rows per date
    and reuses the partitioning of the aggregations.
    """
    keys = ("dt", "device_type", "facility_id")
    good = (
        clean.where(in_dates(start, end))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("good"),
            rounded(mean("battery_pct")).alias("avg_battery_pct"),
            F.min("battery_pct").try_cast(MEASURE).alias("min_battery_pct"),
        )
    )
    bad = quarantine.where(in_dates(start, end)).groupBy(*keys).agg(F.count("*").alias("bad"))
    n_good, n_bad = F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0))
    total = n_good + n_bad
    return full_join(good, bad, keys).select(
        F.col("dt").cast("date").alias("dt"),
        "device_type",
        "facility_id",
        n_good.alias("clean_reading_count"),
        n_bad.alias("quarantined_reading_count"),
        total.alias("total_reading_count"),
        F.round(n_bad.cast("double") * 100 / F.nullif(total, F.lit(0)), 2).cast(RATE).alias("dq_failure_rate_pct"),
        "avg_battery_pct",
        "min_battery_pct",
    )


def max_clean_date(clean: DataFrame, start: str, end: str) -> DataFrame:
    """One row: the last date with clean rows in the range, null when there is none."""
    return clean.where(in_dates(start, end)).agg(F.max("dt").alias("max_dt"))


def avg_temp_by_type(clean: DataFrame, dt: str) -> DataFrame:
    """Average temperature per device type on one date."""
    return clean.where(F.col("dt") == dt).groupBy("device_type").agg(mean("temperature_c").alias("avg_temperature_c"))


def kpi_lookup(kpi: DataFrame, dt: str, device_id: str) -> DataFrame:
    """The rows of one device on one date; prunes to the date's partition."""
    return kpi.where((F.col("dt") == F.lit(dt).cast("date")) & (F.col("device_id") == device_id))
