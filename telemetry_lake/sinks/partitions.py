"""Replacing partitions of a table, whatever the session's settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.lake import Lake
from telemetry_lake.session import sink_settings


def partition_names(spark: SparkSession, lake: Lake, table: str) -> set[str]:
    """What the catalog lists: one name per partition, which the driver's catalog holds anyway."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {lake.table(table)}").collect()}


def replace_partitions(df: DataFrame, lake: Lake, table: str) -> None:
    """Overwrite the partitions that `df` has rows in; all others stay.

    Spark's default is to empty the whole table first, so the mode is set here, for this
    write, not left to the caller. Should a session refuse it, the write does not start;
    should partitions be gone nevertheless, the caller hears of it at once.
    """
    spark = df.sparkSession
    with sink_settings(spark):
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        if mode.lower() != "dynamic":
            raise RuntimeError(f"partitions cannot be replaced one by one: partitionOverwriteMode is {mode}")
        before = partition_names(spark, lake, table)
        df.write.insertInto(lake.table(table), overwrite=True)
    gone = before - partition_names(spark, lake, table)
    if gone:
        raise RuntimeError(f"{lake.table(table)} lost {len(gone)} partitions in a write, among them {min(gone)}")
