"""Raw readings: hive-partitioned JSON lines, restricted to the requested dates and hours."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake import storage
from telemetry_lake.functions.times import event_time
from telemetry_lake.journal import Journal
from telemetry_lake.schemas import NUMERIC_COLUMNS, RAW, RAW_LINE

# A date group is {"dt": "YYYY-MM-DD", "hours": ["00", ...]}; no hours = the whole day.
DateGroup = Mapping


def groups_condition(groups: Iterable[DateGroup]) -> Column:
    """OR over the groups; no groups select nothing.

    Dates asking for the same hours share one IN list, so a long backfill stays a
    small predicate on the partition columns and prunes directories.
    """
    dates_by_hours: dict[tuple[str, ...], list[str]] = {}
    for group in groups:
        dates_by_hours.setdefault(tuple(group.get("hours") or ()), []).append(group["dt"])
    parts = [
        F.col("dt").isin(dates) & F.col("hour").isin(list(hours)) if hours else F.col("dt").isin(dates)
        for hours, dates in dates_by_hours.items()
    ]
    return reduce(lambda left, right: left | right, parts, F.lit(False))


def where_groups(df: DataFrame, groups: Iterable[DateGroup]) -> DataFrame:
    return df.where(groups_condition(groups))


def read_raw(spark: SparkSession, path: str, groups: Iterable[DateGroup] | None = None) -> DataFrame:
    """Scan raw JSON lines below `path` (`dt=.../hour=...`), all of them or some groups.

    With groups only their directories are listed, not years of others: one call tells
    which dates there are, and one more per list of hours that groups ask for. A folder
    that is not there counts as no rows. A line that is not JSON becomes a row of
    nulls with the line in `raw_line`, which the gate quarantines.

    A batch that is being landed is seen as it was before, one whose landing was finished
    as it is now. The journal is asked before and after the files are listed.
    """
    journal = Journal(spark, path)
    hidden = journal.hidden()
    rows = _scan(spark, path, groups)
    names = [F.col("_metadata.file_name").startswith(start) for start in sorted(hidden | journal.hidden())]
    return rows.where(~reduce(lambda left, right: left | right, names)).select(*RAW.names) if names else rows


def _scan(spark: SparkSession, path: str, groups: Iterable[DateGroup] | None) -> DataFrame:
    reader = spark.read.schema(RAW).option("basePath", path).option("columnNameOfCorruptRecord", RAW_LINE)
    if groups is None:
        return reader.json(path) if storage.exists(spark, path) else spark.createDataFrame([], RAW)
    groups = list(groups)
    folders = _folders(spark, path, groups)
    if not folders:
        return spark.createDataFrame([], RAW)
    return where_groups(reader.json(sorted(folders)), groups)


def _folders(spark: SparkSession, path: str, groups: Iterable[DateGroup]) -> set[str]:
    """Existing folders of the groups: whole dates, or hours of dates that are there."""
    groups = list(groups)
    there = set(storage.children(spark, path)) if groups else set()
    found, days_by_hours = set(), {}
    for group in groups:
        day, hours = f"dt={group['dt']}", tuple(group.get("hours") or ())
        if day in there and hours:
            days_by_hours.setdefault(hours, []).append(day)
        elif day in there:
            found.add(f"{path}/{day}")
    for hours, days in days_by_hours.items():
        found.update(storage.matching(spark, f"{path}/{{{','.join(days)}}}/hour={{{','.join(hours)}}}"))
    return found


def normalize(df: DataFrame, numeric_cols: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Numbers spelled as ints, floats or text become DOUBLE; anything else becomes null.

    So do "NaN" and "Infinity": one of them would blank every average it goes into.
    """
    return df.withColumns({c: _finite(F.col(c).try_cast("double")) for c in numeric_cols})


def _finite(number: Column) -> Column:
    return F.when(F.abs(number) < float("inf"), number)  # Spark orders NaN above infinity


def with_event_ts(df: DataFrame, text_col: str = "timestamp") -> DataFrame:
    return df.withColumn("event_ts", event_time(F.col(text_col)))
