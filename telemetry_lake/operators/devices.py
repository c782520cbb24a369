"""The device registry: which devices report, and since when, without a look at all history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_devices(log: DataFrame) -> DataFrame:
    """(device_id, first_dt): every device of a log of sightings with its earliest date."""
    return log.where(F.col("device_id").isNotNull()).groupBy("device_id").agg(_earliest())


def new_devices(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Sightings (device_id, dt) that the registry lacks, or that come before what it has: one row per device."""
    seen = known_devices(found.withColumnRenamed("dt", "first_dt"))
    known = known_devices(registry).withColumnRenamed("first_dt", "known_dt")
    joined = seen.join(known, "device_id", "left")
    return joined.where(F.col("known_dt").isNull() | (F.col("first_dt") < F.col("known_dt"))).select("device_id", "first_dt")


def _earliest():
    # Compared as a date, which is combined in a hash map; the minimum of a text is sorted for.
    return F.min(F.col("first_dt").try_cast("date")).cast("string").alias("first_dt")
