"""Scans of the pipeline's own tables by path, always with their fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake import storage
from telemetry_lake.schemas import AUDIT, CLEAN, MARKS, QUARANTINE


def _read(spark: SparkSession, fmt: str, schema, path: str) -> DataFrame:
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, "parquet", CLEAN, path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The JSON writer leaves null fields out; the schema brings the columns back."""
    return _read(spark, "json", QUARANTINE, path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, "json", AUDIT, path)


def read_mark_log(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, "parquet", MARKS, path)
