"""A readings view of a plain event table, so the jobs run on any (ts, user, type, value) stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry_lake.functions.rules import RangeRule

EVENT_RULES = (
    RangeRule("hvac_unit", "temperature_c", 0.5, 200.0),
    RangeRule("motor", "vibration_mm_s", 0.5, 200.0),
    RangeRule("cold_storage_unit", "temperature_c", 0.5, 200.0),
    RangeRule("smart_meter", "energy_kwh", 0.5, 200.0),
)


def readings_from_events(events: DataFrame) -> DataFrame:
    """Hourly readings: the user is the device, several events of an hour are duplicates.

    Event types stand for device types; `error` for one without rules. Missing values:
    battery for k = 99, the measured value for k = 98, facility for k = 97.
    """
    parsed = events.selectExpr(
        "event_id",
        "cast(user_id AS string) AS device_id",
        "event_type",
        "ts",
        "date_trunc('hour', ts) AS event_ts",
        "cast(value AS decimal(18,2)) AS value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    )
    return parsed.selectExpr(
        "event_id",
        "device_id",
        "CASE event_type WHEN 'click' THEN 'hvac_unit' WHEN 'purchase' THEN 'motor' WHEN 'view' THEN 'cold_storage_unit' "
        "WHEN 'signup' THEN 'smart_meter' WHEN 'error' THEN 'unmapped' END AS device_type",
        "CASE WHEN k <> 97 THEN concat('FAC-0', cast(k % 3 + 1 AS string)) END AS facility_id",
        "concat('zone-', cast(k % 4 AS string)) AS zone",
        "'OK' AS status_code",
        "'1.0.0' AS firmware_version",
        "date_format(event_ts, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\") AS timestamp",
        "event_ts",
        "CASE WHEN k <> 99 THEN cast(k AS double) END AS battery_pct",
        "CASE WHEN k <> 98 AND event_type IN ('click', 'view', 'error') THEN value END AS temperature_c",
        "CASE WHEN event_type IN ('click', 'error') THEN cast(k AS double) END AS humidity_pct",
        "CASE WHEN k <> 98 AND event_type = 'purchase' THEN value END AS vibration_mm_s",
        "CASE WHEN event_type = 'purchase' THEN cast(k AS double) END AS rpm",
        "CASE WHEN event_type = 'view' THEN cast(k AS double) END AS door_open_count",
        "CASE WHEN k <> 98 AND event_type = 'signup' THEN value END AS energy_kwh",
        "CASE WHEN event_type = 'signup' THEN cast(k AS double) END AS voltage",
        "date_format(ts, 'yyyy-MM-dd') AS dt",
        "date_format(ts, 'HH') AS hour",
    )
