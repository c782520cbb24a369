"""Refresh: the five daily KPI tables over a date range."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.times import in_dates
from telemetry_lake.lake import QUARANTINED, READINGS, Lake
from telemetry_lake.operators.kpi import DEVICE_HEALTH_TABLE, DEVICE_KPIS, daily_kpi, device_health, max_clean_date
from telemetry_lake.plans.ingest import move_mark
from telemetry_lake.session import size_shuffles
from telemetry_lake.sinks import range_replace

REFRESH_ID = "kpi_refresh"


def refresh(spark: SparkSession, lake: Lake, start: str, end: str) -> str | None:
    """Replace the range in every KPI table; return the last date with clean rows, or None.

    The mark moves only after all five tables, and only to a date that has rows.
    """
    good, bad = spark.table(lake.table(READINGS)), spark.table(lake.table(QUARANTINED))
    size_shuffles(good.where(in_dates(start, end)))
    range_replace(spark, lake, DEVICE_HEALTH_TABLE, device_health(good, bad, start, end), start, end)
    for spec in DEVICE_KPIS:
        range_replace(spark, lake, spec.table, daily_kpi(good, spec, start, end), start, end)
    # The health table just written knows the dates with clean rows; it has a few rows a date.
    health = spark.table(lake.table(DEVICE_HEALTH_TABLE)).withColumn("dt", F.col("dt").cast("string"))
    last = max_clean_date(health.where("clean_reading_count > 0"), start, end).first().max_dt
    if last is not None:
        move_mark(spark, lake, REFRESH_ID, "last_aggregated_dt", last)
    return last
