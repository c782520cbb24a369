"""What a run found: one grouped pass over the flagged rows answers every later question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.times import mark_key


def run_summary(flagged: DataFrame) -> DataFrame:
    """Rows per (dt, hour, verdict): two rows per hour at most, whatever the volume."""
    return flagged.groupBy("dt", "hour", "_is_bad").agg(F.count("*").alias("rows"))


def run_max_key(found: DataFrame) -> DataFrame:
    """One row: the latest `<dt>T<HH>` found, good or bad rows alike; null when none.

    Takes readings or their run summary.
    """
    return found.agg(F.max(mark_key()).alias("max_key"))


def counts_per_date(summary: DataFrame) -> DataFrame:
    """Good and bad rows per date."""
    rows = F.col("rows")
    return summary.groupBy("dt").agg(
        F.sum(F.when(~F.col("_is_bad"), rows).otherwise(0)).alias("records_clean"),
        F.sum(F.when(F.col("_is_bad"), rows).otherwise(0)).alias("records_quarantined"),
    )


def partition_manifest(summary: DataFrame) -> DataFrame:
    """(dt, hour) found, and for each side whether it has rows there."""
    return summary.groupBy("dt", "hour").agg(
        F.bool_or(~F.col("_is_bad")).alias("has_clean"),
        F.bool_or(F.col("_is_bad")).alias("has_quarantine"),
    )
