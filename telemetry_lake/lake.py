"""Where the tables of one lake live, and their catalog entries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telemetry_lake import storage
from telemetry_lake.schemas import AUDIT, CLEAN, DEVICE, KPI_COLUMNS, MARKS, QUARANTINE, RAW, RAW_LINE

# --- fixed values: table names ---
RAW_READINGS = "raw_readings"
READINGS = "sensor_readings"
QUARANTINED = "quarantine_sensor_readings"
PIPELINE_RUNS = "pipeline_runs"
MARK_LOG = "progress_marks"
DEVICES = "device_registry"
# --- end of fixed values ---


@dataclass(frozen=True)
class Lake:
    """A root folder on shared storage and the database its tables are listed in."""

    root: str
    database: str = "telemetry"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, table: str) -> str:
        return f"{self.database}.{table}"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


# table -> (columns, format, partition columns)
TABLES = {
    RAW_READINGS: (_columns(RAW), "json", ("dt", "hour")),
    READINGS: (_columns(CLEAN), "parquet", ("dt", "hour")),
    QUARANTINED: (_columns(QUARANTINE), "json", ("dt", "hour")),
    PIPELINE_RUNS: (_columns(AUDIT), "json", ("dt",)),
    MARK_LOG: (_columns(MARKS), "parquet", ()),
    DEVICES: (_columns(DEVICE), "parquet", ()),
    **{name: (f"{columns}, dt DATE", "parquet", ("dt",)) for name, columns in KPI_COLUMNS.items()},
}


def create_tables(spark: SparkSession, lake: Lake, tables: Iterable[str] = tuple(TABLES)) -> None:
    """Create the tables that are not there yet; data already in their folders is found again."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database} LOCATION '{lake.root}'")
    for table in tables:
        if spark.catalog.tableExists(lake.table(table)):
            continue
        columns, file_format, partitions = TABLES[table]
        has_data = storage.exists(spark, lake.path(table))
        if not has_data:
            storage.make_folder(spark, lake.path(table))
        spark.sql(
            f"CREATE TABLE {lake.table(table)} ({columns}) USING {file_format} "
            + (f"OPTIONS (columnNameOfCorruptRecord '{RAW_LINE}') " if table == RAW_READINGS else "")
            + (f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else "")
            + f"LOCATION '{lake.path(table)}'"
        )
        if has_data and partitions:
            spark.sql(f"MSCK REPAIR TABLE {lake.table(table)}")


def create_kpi_tables(spark: SparkSession, lake: Lake) -> None:
    create_tables(spark, lake, KPI_COLUMNS)


def _specs(partitions: Iterable[Mapping], separator: str) -> str:
    return separator.join(
        "PARTITION (" + ", ".join(f"{name}='{value}'" for name, value in spec.items()) + ")" for spec in partitions
    )


def register_partitions(spark: SparkSession, lake: Lake, table: str, manifest: DataFrame) -> None:
    """List written partitions in the catalog, after the write; known ones are skipped.

    Inserts into a table do this by themselves; this is for files written by path.
    `manifest` has one row per partition, which is what the catalog holds anyway.
    """
    partitions = [row.asDict() for row in manifest.distinct().orderBy(*manifest.columns).collect()]
    if partitions:
        spark.sql(f"ALTER TABLE {lake.table(table)} ADD IF NOT EXISTS {_specs(partitions, ' ')}")
        spark.catalog.refreshTable(lake.table(table))


def drop_partitions(spark: SparkSession, lake: Lake, table: str, partitions: Iterable[Mapping]) -> None:
    """Remove partitions from the catalog and their folders; those not there are passed over.

    Only the partitions asked for are looked at, however many the table has.
    """
    partitions = list(partitions)
    if not partitions:
        return
    spark.sql(f"ALTER TABLE {lake.table(table)} DROP IF EXISTS {_specs(partitions, ', ')}")
    for spec in partitions:
        storage.delete(spark, "/".join([lake.path(table), *(f"{name}={value}" for name, value in spec.items())]))
    spark.catalog.refreshTable(lake.table(table))


def drop_lake(spark: SparkSession, lake: Lake) -> None:
    """Remove the database with its entries, and all files below the root."""
    spark.sql(f"DROP DATABASE IF EXISTS {lake.database} CASCADE")
    storage.delete(spark, lake.root)
