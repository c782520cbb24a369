"""DataFrame operators."""

from telemetry_lake.operators.audit import audit_records
from telemetry_lake.operators.devices import known_devices, new_devices
from telemetry_lake.operators.gate import clean, dq_gate, duplicate_keys, flag_duplicates, quarantine
from telemetry_lake.operators.kpi import (
    COLD_STORAGE,
    DEVICE_HEALTH_TABLE,
    DEVICE_KPIS,
    ENERGY_VOLTAGE,
    HVAC_STABILITY,
    MOTOR_VIBRATION,
    DailyKpi,
    avg_temp_by_type,
    daily_kpi,
    device_health,
    full_join,
    kpi_lookup,
    max_clean_date,
)
from telemetry_lake.operators.marks import advance_marks, current_marks, newer_marks
from telemetry_lake.operators.planning import (
    backfill_groups,
    check_backfill,
    coverage_gaps,
    expected_partitions,
    missing_dates,
    missing_hours,
)
from telemetry_lake.operators.summary import counts_per_date, partition_manifest, run_max_key, run_summary

__all__ = [
    "COLD_STORAGE",
    "DEVICE_HEALTH_TABLE",
    "DEVICE_KPIS",
    "ENERGY_VOLTAGE",
    "HVAC_STABILITY",
    "MOTOR_VIBRATION",
    "DailyKpi",
    "advance_marks",
    "audit_records",
    "avg_temp_by_type",
    "backfill_groups",
    "check_backfill",
    "clean",
    "counts_per_date",
    "coverage_gaps",
    "current_marks",
    "daily_kpi",
    "device_health",
    "dq_gate",
    "duplicate_keys",
    "expected_partitions",
    "flag_duplicates",
    "full_join",
    "known_devices",
    "kpi_lookup",
    "max_clean_date",
    "missing_dates",
    "missing_hours",
    "new_devices",
    "newer_marks",
    "partition_manifest",
    "quarantine",
    "run_max_key",
    "run_summary",
]
