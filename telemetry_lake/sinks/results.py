"""Sinks for KPI tables, audit records, marks and the device registry."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake import storage
from telemetry_lake.functions.times import in_dates
from telemetry_lake.lake import DEVICES, MARK_LOG, PIPELINE_RUNS, Lake, drop_partitions
from telemetry_lake.operators.devices import known_devices
from telemetry_lake.operators.marks import current_marks
from telemetry_lake.schemas import AUDIT, DEVICE, MARKS
from telemetry_lake.session import sink_settings
from telemetry_lake.sinks.partitions import replace_partitions
from telemetry_lake.storage import Staging

# Files of a log, beside those already replaced, before it is compacted.
LOG_FILES = 16
# The file beside a log's data that lists what its latest snapshot stands for. Scans pass over it.
REPLACED = "_replaced"


def replaced_range(old: DataFrame, new: DataFrame, start: str, end: str) -> DataFrame:
    """`old` with the dates from start to end taken out and `new` put in."""
    return old.where(~in_dates(start, end)).unionByName(new)


def range_replace(spark: SparkSession, lake: Lake, table: str, new: DataFrame, start: str, end: str) -> None:
    """Make the table's dates from start to end exactly `new`; other dates stay.

    Dates with rows are overwritten one by one; dates of the range that have none now
    are dropped. Running it again after a failure gives the same table.
    """
    columns = spark.table(lake.table(table)).columns
    with Staging(spark) as staging:
        new = staging.save(new.select(*columns), table)
        # At most one value per date of the range.
        present = {str(row.dt) for row in new.select("dt").distinct().collect()}
        replace_partitions(new.hint("rebalance", "dt"), lake, table)
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    days = (str(first + timedelta(days=n)) for n in range((last - first).days + 1))
    drop_partitions(spark, lake, table, [{"dt": day} for day in days if day not in present])


def append_audit(records: DataFrame, lake: Lake) -> None:
    """Add audit records; earlier ones are never touched."""
    with sink_settings(records.sparkSession):
        records.select(*AUDIT.names).write.insertInto(lake.table(PIPELINE_RUNS))


def append_marks(records: DataFrame, lake: Lake) -> None:
    """Add mark records; the log's snapshot holds one record per key."""
    records = records.select(*(F.col(c).cast("string") for c in MARKS.names)).coalesce(1)
    _append_log(records, lake, MARK_LOG, MARKS, lambda log: current_marks(log).coalesce(1))


def append_devices(records: DataFrame, lake: Lake) -> None:
    """Add devices to the registry; its snapshot holds one record per device."""
    _append_log(records.select(*DEVICE.names).hint("rebalance"), lake, DEVICES, DEVICE, lambda log: known_devices(log).hint("rebalance"))


def _append_log(records: DataFrame, lake: Lake, table: str, schema, condense: Callable[[DataFrame], DataFrame]) -> None:
    """Add records to a log, of which a snapshot says the same in fewer rows.

    Past LOG_FILES files a snapshot is added, and the files it stands for are written down
    beside it. They are removed one compaction later: whoever listed the files before a
    compaction can still read them, and seeing both says nothing else, as the records of a
    log are combined by a maximum or minimum. A crash anywhere loses and changes nothing.
    """
    spark, path = records.sparkSession, lake.path(table)
    with sink_settings(spark):
        records.write.insertInto(lake.table(table))
        note = f"{path}/{REPLACED}"
        replaced = set(storage.read_text(spark, note).split()) if storage.exists(spark, note) else set()
        files = {name for name in storage.children(spark, path) if name.endswith(".parquet")}
        live = files - replaced
        if len(live) <= LOG_FILES:
            return
        snapshot = condense(spark.read.schema(schema).parquet(*(f"{path}/{name}" for name in sorted(live))))
        snapshot.write.insertInto(lake.table(table))
        storage.delete(spark, note)
        for name in sorted(files & replaced):
            storage.delete(spark, f"{path}/{name}")
        storage.write_text(spark, note, "\n".join(sorted(live)))
        spark.catalog.refreshTable(lake.table(table))
