"""Jobs composed from the operators."""

from telemetry_lake.plans.coverage import coverage
from telemetry_lake.plans.ingest import INGEST_ID, ingest
from telemetry_lake.plans.refresh import REFRESH_ID, refresh
from telemetry_lake.plans.run import RunResult, due_dates, due_groups, run

__all__ = ["INGEST_ID", "REFRESH_ID", "RunResult", "coverage", "due_dates", "due_groups", "ingest", "refresh", "run"]
