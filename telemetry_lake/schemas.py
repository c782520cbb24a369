"""Fixed schemas: nothing is inferred, so `hour` stays "00" and no scan is spent on it."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the column names of the telemetry tables ---
TEXT_COLUMNS = ("device_id", "device_type", "facility_id", "zone", "status_code", "firmware_version")
NUMERIC_COLUMNS = (
    "battery_pct",
    "temperature_c",
    "humidity_pct",
    "vibration_mm_s",
    "rpm",
    "door_open_count",
    "energy_kwh",
    "voltage",
)
PARTITION_COLUMNS = ("dt", "hour")
# The text of a line that cannot be read, for the people who look at the quarantine.
RAW_LINE = "raw_line"
# --- end of fixed values ---


def _fields(names, data_type) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


_PARTITIONS = _fields(PARTITION_COLUMNS, T.StringType())

# Producers mix ints, floats, quoted numbers and nulls in one field. Reading the
# number as text keeps every spelling; `normalize` casts it without failing.
RAW = T.StructType(
    _fields(TEXT_COLUMNS + ("timestamp",), T.StringType())
    + _fields(NUMERIC_COLUMNS, T.StringType())
    + _fields((RAW_LINE,), T.StringType())
    + _PARTITIONS
)

CLEAN = T.StructType(
    _fields(TEXT_COLUMNS, T.StringType())
    + _fields(NUMERIC_COLUMNS, T.DoubleType())
    + [T.StructField("event_ts", T.TimestampType())]
    + _PARTITIONS
)

# Quarantine keeps the original time text, and event_ts as text too: it is a
# JSON table that people read.
QUARANTINE = T.StructType(
    _fields(TEXT_COLUMNS + ("timestamp",), T.StringType())
    + _fields(NUMERIC_COLUMNS, T.DoubleType())
    + _fields(("event_ts", RAW_LINE), T.StringType())
    + _PARTITIONS
)

# --- fixed values: columns of the audit, mark and KPI tables ---
AUDIT = T.StructType(
    _fields(
        ("run_id", "run_timestamp", "target_date", "hours_processed", "status", "started_at", "completed_at"),
        T.StringType(),
    )
    + [
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("records_clean", T.LongType()),
        T.StructField("records_quarantined", T.LongType()),
        T.StructField("dt", T.StringType()),
    ]
)

MARKS = T.StructType(
    _fields(
        ("pipeline_id", "status", "last_loaded_dt", "last_loaded_hour", "last_loaded_key", "last_aggregated_dt"),
        T.StringType(),
    )
)

# Sightings of devices: the registry is a log of them.
DEVICE = T.StructType(_fields(("device_id", "first_dt"), T.StringType()))

GROUPS = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("hours", T.ArrayType(T.StringType())),
    ]
)

# Column lists of the daily KPI tables; dt, the partition column, comes last in Spark. Keys
# are STRING: a long one must not stop a run, and is never shortened.
KPI_COLUMNS = {
    "daily_device_health_summary": (
        "device_type STRING, facility_id STRING, clean_reading_count BIGINT, "
        "quarantined_reading_count BIGINT, total_reading_count BIGINT, dq_failure_rate_pct DECIMAL(5,2), "
        "avg_battery_pct DECIMAL(10,2), min_battery_pct DECIMAL(10,2)"
    ),
    "daily_motor_vibration_trend": (
        "device_id STRING, facility_id STRING, avg_vibration_mm_s DECIMAL(10,2), "
        "max_vibration_mm_s DECIMAL(10,2), reading_count BIGINT"
    ),
    "daily_cold_storage_risk": (
        "device_id STRING, facility_id STRING, avg_temperature_c DECIMAL(10,2), "
        "total_door_open_count BIGINT, reading_count BIGINT"
    ),
    "daily_hvac_stability": (
        "device_id STRING, facility_id STRING, zone STRING, avg_temperature_c DECIMAL(10,2), "
        "stddev_temperature_c DECIMAL(10,2), reading_count BIGINT"
    ),
    "daily_energy_voltage_summary": (
        "device_id STRING, facility_id STRING, total_energy_kwh DECIMAL(10,2), "
        "avg_voltage DECIMAL(10,2), min_voltage DECIMAL(10,2), reading_count BIGINT"
    ),
}
# --- end of fixed values ---
