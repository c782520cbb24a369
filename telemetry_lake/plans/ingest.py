"""Ingest: raw readings of some hours through the gate into the clean and quarantine tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.rules import REPORT_KEY, REQUIRED_COLUMNS, SENSOR_RULES, RangeRule
from telemetry_lake.lake import DEVICES, MARK_LOG, QUARANTINED, RAW_READINGS, READINGS, Lake, drop_partitions
from telemetry_lake.operators import gate
from telemetry_lake.operators.audit import audit_records
from telemetry_lake.operators.devices import new_devices
from telemetry_lake.operators.marks import current_marks, newer_marks
from telemetry_lake.operators.summary import partition_manifest, run_max_key, run_summary
from telemetry_lake.schemas import GROUPS
from telemetry_lake.session import size_shuffles
from telemetry_lake.sinks import append_audit, append_devices, append_marks, write_clean, write_quarantine
from telemetry_lake.sources.raw import DateGroup, normalize, read_raw, with_event_ts
from telemetry_lake.storage import Staging

INGEST_ID = "ingest"


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def ingest(
    spark: SparkSession,
    lake: Lake,
    groups: Sequence[DateGroup],
    *,
    rules: Iterable[RangeRule] = SENSOR_RULES,
    required: Iterable[str] = REQUIRED_COLUMNS,
    key: Sequence[str] = REPORT_KEY,
    prune_stale: bool = True,
    filter_blocks: int = gate.FILTER_BLOCKS,
) -> str | None:
    """Run the stage for the given date groups; return the latest `<dt>T<HH>` found, or None.

    Order: write, register (by the inserts), audit, devices, mark. A crash at any point means the
    same work is done again, never that work is taken as done. With `prune_stale`, an hour
    read by this run that now has no good (or no bad) rows loses its old partition.
    """
    started = _utc_now()
    raw = read_raw(spark, lake.path(RAW_READINGS), groups)
    size_shuffles(raw)
    readings = with_event_ts(normalize(raw))
    with Staging(spark) as staging:
        # First pass, key columns only; second pass, all columns, without a shuffle. Both are
        # stored on the shared folder, so that a lost executor costs no further parse. Only
        # rows that may be copies are then moved, to the repeated keys.
        keys = staging.save(gate.duplicate_keys(readings, key), "duplicate_keys")
        marked = staging.save(gate.mark_suspects(readings, key, keys, filter_blocks), "marked")
        settled = staging.save(gate.settle_suspects(marked, key, keys), "settled")
        told = marked.where(F.col("_dup").isNotNull())
        flagged = gate.with_verdict(told.unionByName(settled), rules, required)
        summary = staging.save(run_summary(flagged), "summary")
        max_key = run_max_key(summary).first().max_key
        if max_key is None:
            return None
        write_clean(gate.clean(flagged), lake)
        write_quarantine(gate.quarantine(flagged), lake)
        if prune_stale:
            _prune(spark, lake, partition_manifest(summary))
        run = _run_values(started)
        requested = spark.createDataFrame([(g["dt"], list(g.get("hours") or [])) for g in groups], GROUPS)
        append_audit(audit_records(requested, summary, max_key.split("T")[0], run), lake)
        newcomers = staging.save(new_devices(flagged.select("device_id", "dt"), spark.table(lake.table(DEVICES))), "newcomers")
        if not newcomers.isEmpty():
            append_devices(newcomers, lake)
    move_mark(spark, lake, INGEST_ID, "last_loaded_key", max_key)
    return max_key


def _prune(spark: SparkSession, lake: Lake, manifest: DataFrame) -> None:
    """Drop what an earlier run wrote for hours whose rows are now all on the other side."""
    one_sided = [row.asDict() for row in manifest.where(~(F.col("has_clean") & F.col("has_quarantine"))).collect()]
    for table, side in ((READINGS, "has_clean"), (QUARANTINED, "has_quarantine")):
        gone = [{"dt": row["dt"], "hour": row["hour"]} for row in one_sided if not row[side]]
        drop_partitions(spark, lake, table, gone)


def _run_values(started: datetime) -> dict:
    completed = _utc_now()
    return {
        "run_id": f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}",
        "run_timestamp": started.isoformat(),
        "status": "SUCCESS",
        "started_at": started.isoformat(),
        "completed_at": completed.isoformat(),
        "duration_seconds": round((completed - started).total_seconds(), 1),
    }


def move_mark(spark: SparkSession, lake: Lake, pipeline_id: str, column: str, value: str) -> None:
    """Record the value for the pipeline if it is ahead of its mark."""
    found = spark.createDataFrame([(pipeline_id, value)], ["pipeline_id", column])
    newer = newer_marks(current_marks(spark.table(lake.table(MARK_LOG))), found)
    if not newer.isEmpty():
        append_marks(newer, lake)
