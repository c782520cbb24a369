"""Forward-only progress marks.

The stored form is an append-only log; a key's mark is the maximum over its records.
An older record can therefore never move a mark back, and two writers need no lock.

Hours and dates are compared as numbers and dates, not as text: the maximum of a text
makes Spark sort all rows by key, that of a number is combined in a hash map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.times import key_number, key_text
from telemetry_lake.schemas import MARKS

VALUES = ("last_loaded_key", "last_aggregated_dt")


def _latest(rows: DataFrame) -> DataFrame:
    """Latest key and date per pipeline_id, of the columns that `rows` has."""
    text = F.lit(None).cast("string")
    rows = rows.withColumns({name: text for name in VALUES if name not in rows.columns})
    return rows.groupBy("pipeline_id").agg(
        key_text(F.max(key_number(F.col("last_loaded_key")))).alias("last_loaded_key"),
        F.max(F.col("last_aggregated_dt").try_cast("date")).cast("string").alias("last_aggregated_dt"),
    )


def _records(df: DataFrame) -> DataFrame:
    """Full mark records: date and hour are the parts of the key."""
    parts = F.split("last_loaded_key", "T")
    return df.withColumns({"last_loaded_dt": parts[0], "last_loaded_hour": parts[1]}).select(*MARKS.names)


def current_marks(log: DataFrame) -> DataFrame:
    """The marks a log of records stands for, one per key."""
    return _records(_latest(log).withColumn("status", F.lit(None).cast("string")))


def advance_marks(marks: DataFrame, found: DataFrame) -> DataFrame:
    """Marks after a run: per key the later of its mark and what was found.

    `marks` has one row per key. `found` has pipeline_id and last_loaded_key and/or
    last_aggregated_dt, any number of rows per key, combined before the shuffle. A null
    or older value changes nothing.
    """
    return _records(_advanced(marks, found))


def _advanced(marks: DataFrame, found: DataFrame) -> DataFrame:
    """The later values, and the marks' own as `old_...`."""
    new = _latest(found).select("pipeline_id", *(F.col(c).alias(f"new_{c}") for c in VALUES))
    joined = marks.join(new, "pipeline_id", "full").withColumns({f"old_{c}": F.col(c) for c in VALUES})
    return joined.withColumns({c: F.greatest(c, f"new_{c}") for c in VALUES})


def newer_marks(marks: DataFrame, found: DataFrame) -> DataFrame:
    """The part of `found` that moves a mark forward, one full record per key."""
    same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in VALUES]
    return _records(_advanced(marks, found).where(~(same[0] & same[1])))
