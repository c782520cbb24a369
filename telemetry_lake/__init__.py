"""Batch jobs for partitioned telemetry tables on Spark."""

from telemetry_lake.lake import Lake, create_kpi_tables, create_tables
from telemetry_lake.session import build_session, configure

__all__ = ["Lake", "build_session", "configure", "create_kpi_tables", "create_tables"]
