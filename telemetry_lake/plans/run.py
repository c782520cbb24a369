"""One run of the lake: plan what is due, ingest it, refresh the KPIs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from telemetry_lake.lake import MARK_LOG, Lake, create_tables
from telemetry_lake.operators.marks import current_marks
from telemetry_lake.operators.planning import (
    MAX_BACKFILL_DAYS,
    backfill_groups,
    check_backfill,
    missing_dates,
    missing_hours,
)
from telemetry_lake.plans.ingest import INGEST_ID, ingest
from telemetry_lake.plans.refresh import REFRESH_ID, refresh
from telemetry_lake.session import job_settings
from telemetry_lake.sources.raw import DateGroup

MODES = ("full", "ingest_only", "kpi_only")


@dataclass(frozen=True)
class RunResult:
    """What a run did; None where there was nothing to do."""

    groups: list[DateGroup]
    loaded_until: str | None
    dates: tuple[str, str] | None
    aggregated_until: str | None


def run(
    spark: SparkSession,
    lake: Lake,
    mode: str = "full",
    backfill: Mapping[str, str] | None = None,
    now: datetime | None = None,
    max_days: int = MAX_BACKFILL_DAYS,
    **ingest_options,
) -> RunResult:
    """Run the stages of `mode`; `backfill` is {"start_date", "end_date"} instead of the marks.

    The session's settings are those of the caller again when it ends.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")
    if backfill:
        check_backfill(backfill["start_date"], backfill["end_date"], max_days)
    now = now or datetime.now(timezone.utc)

    groups, loaded, dates, aggregated = [], None, None, None
    with job_settings(spark):
        create_tables(spark, lake)
        if mode != "kpi_only":
            groups = due_groups(spark, lake, backfill, now, max_days)
            loaded = ingest(spark, lake, groups, **ingest_options) if groups else None
        if mode != "ingest_only":
            dates = due_dates(spark, lake, backfill, now)
            aggregated = refresh(spark, lake, *dates) if dates else None
    return RunResult(groups, loaded, dates, aggregated)


def due_groups(
    spark: SparkSession, lake: Lake, backfill: Mapping[str, str] | None, now: datetime, max_days: int = MAX_BACKFILL_DAYS
) -> list[DateGroup]:
    """Date groups of one lake, oldest first: one small row per date."""
    if backfill:
        due = backfill_groups(spark, backfill["start_date"], backfill["end_date"], max_days)
    else:
        own = spark.createDataFrame([(INGEST_ID,)], ["pipeline_id"])
        due = missing_hours(own.join(_marks(spark, lake), "pipeline_id", "left"), now)
    return [{"dt": row.dt, "hours": row.hours} for row in due.orderBy("dt").collect()]


def due_dates(
    spark: SparkSession, lake: Lake, backfill: Mapping[str, str] | None, now: datetime
) -> tuple[str, str] | None:
    if backfill:
        return backfill["start_date"], backfill["end_date"]
    links = spark.createDataFrame([(REFRESH_ID, INGEST_ID)], ["pipeline_id", "upstream_id"])
    due = missing_dates(_marks(spark, lake), links, now.date()).first()
    return (due.start_date, due.end_date) if due else None


def _marks(spark: SparkSession, lake: Lake):
    return current_marks(spark.table(lake.table(MARK_LOG)))
