"""Time texts: event time, dt/hour partition values, the `<dt>T<HH>` mark key, date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """ISO-8601 text to timestamp; null when it cannot be read.

    A text without a date would be read as of today, another time on each run, so it is null.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(text))


def event_time_text(ts: Column) -> Column:
    """Timestamp as ISO-8601 text, the spelling used in the quarantine table."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def mark_key(dt: str = "dt", hour: str = "hour") -> Column:
    """`<dt>T<HH>`: zero padded, so text order is time order and max() works."""
    return F.concat_ws("T", F.col(dt), F.col(hour))


def key_number(key: Column) -> Column:
    """The mark key's digits as a number, in the same order; null for another text."""
    return F.translate(key, "-T", "").try_cast("bigint")


def key_text(number: Column) -> Column:
    """The mark key of `key_number`."""
    digits = number.cast("string")
    date_parts = F.concat_ws("-", *(F.substr(digits, F.lit(a), F.lit(n)) for a, n in ((1, 4), (5, 2), (7, 2))))
    return F.when(number.isNotNull(), F.concat_ws("T", date_parts, F.substr(digits, F.lit(9), F.lit(2))))


def in_dates(start: str, end: str, dt: str = "dt") -> Column:
    """Inclusive date range. Compares text with text, so the scan can prune on dt."""
    return F.col(dt).between(start, end)
