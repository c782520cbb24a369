"""Audit records: one per requested date that the run reached."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.operators.summary import counts_per_date
from telemetry_lake.schemas import AUDIT


def audit_records(groups: DataFrame, summary: DataFrame, last_dt: Column | str, run: Mapping) -> DataFrame:
    """One record per date of `groups` (dt, hours) that is not after `last_dt`.

    `last_dt` is the date of the latest hour found: a later date was requested but never
    confirmed, so nothing is claimed about it. A date without rows gets zero counts.
    `run` holds the values that are the same for all records of the run.
    """
    reached = groups.where(F.col("dt") <= last_dt)
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("records_clean", "records_quarantined")]
    hours = F.when(F.size("hours") > 0, F.concat_ws(",", "hours")).otherwise("ALL")
    records = reached.join(counts_per_date(summary), "dt", "left").select(
        "dt", F.col("dt").alias("target_date"), hours.alias("hours_processed"), *counts
    )
    constants = {name: F.lit(value).cast(AUDIT[name].dataType) for name, value in run.items()}
    return records.withColumns(constants).select(*AUDIT.names)
