"""Coverage: hours of a range that devices of the lake have no readings for, good or bad."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.lake import DEVICES, QUARANTINED, READINGS, Lake
from telemetry_lake.operators.devices import known_devices
from telemetry_lake.operators.planning import coverage_gaps


def coverage(spark: SparkSession, lake: Lake, start: str, end: str) -> DataFrame:
    """(device_id, dt, hours) for every registered device and date from start to end that lacks some.

    Devices come from the registry that ingest keeps, so nothing outside the range is read.
    """
    columns = ("device_id", "dt", "hour")
    good, bad = (spark.table(lake.table(table)).select(*columns) for table in (READINGS, QUARANTINED))
    return coverage_gaps(good.unionByName(bad), "device_id", start, end, known_devices(spark.table(lake.table(DEVICES))))
