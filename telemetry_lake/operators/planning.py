"""Which hours and dates are due, from progress marks and a clock given as a parameter.

Each operator plans every key of a marks table at once. Hours and dates are generated
per row, so planning needs no shuffle beyond the joins of M2 and scales with the keys.
Times are UTC without a zone (TIMESTAMP_NTZ), hence independent of session settings.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.times import in_dates, two_digits
from telemetry_lake.schemas import GROUPS

# --- fixed values: backfill limit in days, hours looked back without a mark ---
MAX_BACKFILL_DAYS = 90
FALLBACK_HOURS = 24
# --- end of fixed values ---


def _moment(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _day(value: date) -> Column:
    return F.lit(value.strftime("%Y-%m-%d")).cast("date")


def _hours(first: Column, last: Column) -> Column:
    """["05", "06", ...] from first to last, both included."""
    return F.transform(F.sequence(first, last), two_digits)


def missing_hours(marks: DataFrame, now: datetime) -> DataFrame:
    """Due hours per key and date: (pipeline_id, dt, hours).

    From the hour after the mark to the last complete hour before `now`. A key without
    a mark looks FALLBACK_HOURS back from the current hour. Nothing due gives no row.
    """
    this_hour = now.replace(minute=0, second=0, microsecond=0)
    last = this_hour - timedelta(hours=1)
    loaded = F.to_timestamp_ntz(F.concat_ws(" ", "last_loaded_dt", "last_loaded_hour"), F.lit("yyyy-MM-dd HH"))
    loaded = F.when(F.col("last_loaded_dt").isNotNull() & F.col("last_loaded_hour").isNotNull(), loaded)
    first = F.coalesce(loaded, _moment(this_hour - timedelta(hours=FALLBACK_HOURS))) + F.expr("INTERVAL 1 HOUR")

    due = marks.select("pipeline_id", first.alias("first")).where(F.col("first") <= _moment(last))
    first_day, last_day = F.to_date("first"), _day(last.date())
    days = due.select("pipeline_id", "first", F.explode(F.sequence(first_day, last_day)).alias("day"))
    return days.select(
        "pipeline_id",
        F.col("day").cast("string").alias("dt"),
        _hours(
            F.when(F.col("day") == first_day, F.hour("first")).otherwise(0),
            F.when(F.col("day") == last_day, F.lit(last.hour)).otherwise(23),
        ).alias("hours"),
    )


def missing_dates(marks: DataFrame, links: DataFrame, today: date) -> DataFrame:
    """Due date range per key: (pipeline_id, start_date, end_date).

    `links` has (pipeline_id, upstream_id). The range starts after the key's own
    aggregated date (yesterday without one) and ends with the last closed date of its
    upstream: the mark's date once hour 23 is loaded, else the day before. Without an
    upstream mark, or with an empty range, the key has no row.
    """
    own = marks.select("pipeline_id", "last_aggregated_dt")
    upstream = marks.where(F.col("last_loaded_dt").isNotNull()).select(
        F.col("pipeline_id").alias("upstream_id"), "last_loaded_dt", "last_loaded_hour"
    )
    loaded = F.col("last_loaded_dt").cast("date")
    closed = F.when(F.col("last_loaded_hour") == "23", loaded).otherwise(F.date_sub(loaded, 1))
    start = F.coalesce(F.date_add(F.col("last_aggregated_dt").cast("date"), 1), F.date_sub(_day(today), 1))
    return (
        links.join(upstream, "upstream_id")
        .join(own, "pipeline_id", "left")
        .select("pipeline_id", start.alias("start_date"), closed.alias("end_date"))
        .where("start_date <= end_date")
        .select("pipeline_id", *(F.col(c).cast("string").alias(c) for c in ("start_date", "end_date")))
    )


def check_backfill(start: str, end: str, max_days: int = MAX_BACKFILL_DAYS) -> None:
    """Reject a reversed range and one longer than `max_days`, both ends counted."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if days < 1:
        raise ValueError(f"backfill end_date {end} lies before start_date {start}")
    if days > max_days:
        raise ValueError(f"backfill of {days} days is over the {max_days}-day safety cap; split the range")


def backfill_groups(spark: SparkSession, start: str, end: str, max_days: int = MAX_BACKFILL_DAYS) -> DataFrame:
    """Every date of the range as a whole day: (dt, hours) with no hours. Marks are not read."""
    check_backfill(start, end, max_days)
    return _dates(spark, start, end).select(
        F.col("day").cast("string").alias("dt"), F.array().cast(GROUPS["hours"].dataType).alias("hours")
    )


def expected_partitions(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The calendar (dt, hour): hours 00 to 23 of every date from start to end."""
    return _dates(spark, start, end).select(
        F.col("day").cast("string").alias("dt"), F.explode(_hours(F.lit(0), F.lit(23))).alias("hour")
    )


def _dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    first, last = _day(date.fromisoformat(start)), _day(date.fromisoformat(end))
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("day")).where(F.col("day") >= first)


def coverage_gaps(readings: DataFrame, key: str, start: str, end: str, keys: DataFrame | None = None) -> DataFrame:
    """Expected hours without rows: (key, dt, hours), for every key and date that lacks some.

    An hour skipped in mid-day never becomes due again by the marks; this finds it.
    `keys` says which keys report (by default all that ever did, which reads all history;
    the lake's device registry spares that), so a key without any row in the range appears
    too. Only the range is scanned for hours. A key's day is reduced to a 24-bit map before
    the shuffle, and only these maps are moved, never the calendar: a day with some hours
    gives its own gaps, and the days without any are what the range has beyond those, taken
    as a difference of two lists per key. The work is linear in keys and days.
    """
    known = F.col(key).isNotNull()
    keys = (readings if keys is None else keys).where(known).select(key).distinct()
    seen_hours = (
        readings.where(known & in_dates(start, end))
        .groupBy(key, "dt")
        .agg(F.expr("bit_or(shiftleft(1, cast(hour AS int)))").alias("seen"))
    )
    by_date = seen_hours.groupBy(key).agg(F.collect_list(F.struct("dt", "seen")).alias("by_date"))
    first, last = (_day(date.fromisoformat(d)) for d in (start, end))
    calendar = F.transform(F.sequence(first, last), lambda day: day.cast("string"))
    gaps = F.expr("filter(by_date, d -> d.seen <> (1 << 24) - 1)")
    whole_days = F.transform(
        F.array_except(calendar, F.coalesce(F.col("by_date.dt"), F.array().cast("array<string>"))),
        lambda dt: F.struct(dt.alias("dt"), F.lit(0).alias("seen")),
    )
    gaps = F.concat(F.coalesce(gaps, F.array().cast("array<struct<dt:string,seen:int>>")), whole_days)
    days = keys.join(by_date, key, "left").select(key, F.explode(gaps).alias("day")).select(key, "day.dt", "day.seen")
    unseen = F.expr("filter(sequence(0, 23), h -> getbit(seen, h) = 0)")
    return days.select(key, "dt", F.transform(unseen, two_digits).alias("hours"))
