"""Sinks for readings. A rerun gives the same rows: tables replace whole hours, landing its own batch."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.times import date_text, event_time, event_time_text, hour_text
from telemetry_lake.journal import Journal, Landing, base_name
from telemetry_lake.lake import QUARANTINED, RAW_READINGS, READINGS, Lake, create_tables, register_partitions
from telemetry_lake.schemas import CLEAN, QUARANTINE, RAW_LINE
from telemetry_lake.session import settings, sink_settings
from telemetry_lake.sinks.partitions import replace_partitions
from telemetry_lake.storage import Staging

# Bytes of landed rows that a task holds while it sorts them by hour, about; three times that at most.
LAND_BYTES = 64 << 20
# A staged file holds so many rows at most, and a task reads one file, or part of one.
STAGED_ROWS = 250_000
ONE_FILE = {"spark.sql.files.maxPartitionBytes": "4MB", "spark.sql.files.openCostInBytes": "4MB"}


def _replace_hours(df: DataFrame, lake: Lake, table: str, *order: str) -> None:
    """Overwrite the hours found in `df`; the insert lists them in the catalog.

    A task holds rows of many hours, whether they come from a shuffle or from a scan that
    packs small files. The rebalance gathers an hour into few files and splits a large
    one. Sorting by device type inside an hour replaces the writer's own sort and lets
    later scans skip row groups.
    """
    df = df.hint("rebalance", "dt", "hour")
    replace_partitions(df.sortWithinPartitions("dt", "hour", *order), lake, table)


def write_clean(df: DataFrame, lake: Lake) -> None:
    """Clean readings as Parquet."""
    _replace_hours(df.select(*CLEAN.names), lake, READINGS, "device_type", "device_id")


def write_quarantine(df: DataFrame, lake: Lake) -> None:
    """Bad readings as JSON, for people to look at; with the text of lines that cannot be read."""
    with sink_settings(df.sparkSession):
        as_text = df.withColumn("event_ts", event_time_text(F.col("event_ts")))
        if RAW_LINE not in df.columns:
            as_text = as_text.withColumn(RAW_LINE, F.lit(None).cast("string"))
        _replace_hours(as_text.select(*QUARANTINE.names), lake, QUARANTINED)


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: eight bytes a column, and the bytes of texts and nested values."""
    total = F.lit(8 * len(df.columns))
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total.cast("long")


def deal_hours(sizes: Sequence[int], task_bytes: int) -> list[tuple[int, int]]:
    """For each hour, in order, its first task and over how many its rows are dealt.

    Small hours share a task, a large one is dealt over several. A task gets less than
    `task_bytes` of hours that begin and end before it is full, and at most as much again
    of the hour that ends in it and of the one that begins last.
    """
    dealt, before = [], 0
    for size in sizes:
        dealt.append((before // task_bytes, max(1, -(-size // task_bytes))))
        before += size
    return dealt


def _dealt(landed: DataFrame, hours: Sequence[tuple[str, str]], sizes: Sequence[int]) -> DataFrame:
    """The rows in tasks of bounded bytes, whatever share of them one hour has.

    The writer sorts a task's rows by hour in memory. Readings of unreadable time all share an
    hour, and a rebalance, which goes by compressed bytes, would sort a gigabyte of them in one task.
    """
    dealt = deal_hours(sizes, LAND_BYTES)
    tasks = max(first + span for first, span in dealt)
    rows = [(*hour, *own) for hour, own in zip(hours, dealt, strict=True)]
    plan = landed.sparkSession.createDataFrame(rows, "dt string, hour string, _first long, _span long")
    # Staged rows come in the same order whenever a task is run again.
    task = (F.col("_first") + F.pmod(F.monotonically_increasing_id(), F.col("_span"))).cast("int")
    placed = landed.join(F.broadcast(plan), ["dt", "hour"]).withColumn("_task", task).drop("_first", "_span")
    return placed.repartitionById(tasks, "_task").drop("_task")


def land_raw(df: DataFrame, lake: Lake, batch: str, landed_at: datetime, time_col: str = "timestamp") -> None:
    """Put a batch of incoming readings into the raw table, as JSON lines below the hour of their own time (UTC).

    `batch` names the batch. Landing it again replaces what it held, in all hours, and
    nothing else: a corrected batch takes the place of the old one, and a late or repeated
    one never takes rows of another away. The journal makes that one step for readers: until
    the new files are all there and listed the old ones count, then only the new ones. A
    landing that was broken off is undone, or finished, when the batch is landed again or by
    `settle_landing`; no rows of it are lost or doubled meanwhile.

    Hours are listed in the catalog. `landed_at` belongs to the batch: a reading whose time
    cannot be read is filed under that hour, so that the gate gets to see it. The input is
    evaluated once, into a staged table. No readings write nothing, or empty the batch.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"batch {batch!r} is not made of letters, digits, _ and -")
    spark, path = df.sparkSession, lake.path(RAW_READINGS)
    create_tables(spark, lake, [RAW_READINGS])
    journal = Journal(spark, path)
    settle_landing(spark, lake, batch)
    with sink_settings(spark), Staging(spark) as staging:
        filed_under = F.lit(landed_at.strftime("%Y-%m-%d %H:00:00")).cast("timestamp")
        ts = F.coalesce(event_time(F.col(time_col)), filed_under)
        landed = staging.save(df.withColumns({"dt": date_text(ts), "hour": hour_text(ts)}), "landed", STAGED_ROWS)
        # At most one row per hour of the batch.
        with settings(spark, ONE_FILE):
            sizes = landed.groupBy("dt", "hour").agg(F.sum(_row_bytes(landed)).alias("bytes")).orderBy("dt", "hour").collect()
        hours = [(row.dt, row.hour) for row in sizes]
        versions = journal.versions(batch)
        if not hours and not versions:
            return
        new = Landing(versions[-1] + 1 if versions else 0, uuid.uuid4().hex, tuple(hours))
        journal.begin(batch, new)
        if hours:
            with settings(spark, ONE_FILE):
                writer = _dealt(landed, hours, [row.bytes for row in sizes]).write.mode("append").partitionBy("dt", "hour")
                writer.option("mapreduce.output.basename", base_name(batch, new.attempt)).json(path)
            register_partitions(spark, lake, RAW_READINGS, spark.createDataFrame(hours, landed.select("dt", "hour").schema))
        files = tuple(journal.files_of(batch, new))
        journal.commit(batch, Landing(new.number, new.attempt, new.hours, files))
    settle_landing(spark, lake, batch)


def settle_landing(spark: SparkSession, lake: Lake, batch: str) -> None:
    """Finish or undo a landing of the batch that was broken off; otherwise nothing happens."""
    Journal(spark, lake.path(RAW_READINGS)).settle(batch)
    spark.catalog.refreshTable(lake.table(RAW_READINGS))
