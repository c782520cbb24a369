"""Spark session settings the jobs rely on."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job needs, whoever created the session.
JOB_CONF = {
    # dt/hour texts are UTC; formatting a timestamp must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # Overwriting replaces only the dt/hour partitions present in the new rows.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # AQE sizes shuffle partitions from real volumes and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Larger scan splits and shuffle partitions than the defaults: raw text shrinks to a
    # tenth as Parquet, and a split or a rebalanced partition becomes one output file.
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # A shuffled join whose smaller side turns out to have partitions up to this size
    # looks rows up in a hash map instead of sorting the wide side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# What a sink needs, whatever the caller's session says: hours in UTC, and an overwrite that
# replaces the partitions of the new rows only. With Spark's default it would empty the table.
SINK_CONF = {name: JOB_CONF[name] for name in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode")}

# Settings that must be there when the session is created.
CREATION_CONF = {
    # Do not look up the Python call site of every column expression: rules make many.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Input per shuffle partition to start with: what an executor's core sorts in memory.
PARTITION_BYTES = 256 << 20
# What Spark takes a table for whose size it does not know.
UNKNOWN_SIZE = (1 << 63) - 1
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to an existing session and return it."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str], *others: str) -> Iterator[None]:
    """Settings for a while; afterwards the session has its own again, of `others` too.

    For work that ends inside: a lazy result that is read later runs with the settings of then.
    """
    before = {name: spark.conf.get(name, None) for name in (*conf, *others)}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def job_settings(spark: SparkSession):
    """The job settings for a while."""
    return settings(spark, JOB_CONF, INITIAL_PARTITIONS)


def sink_settings(spark: SparkSession):
    """What a sink needs for a while."""
    return settings(spark, SINK_CONF)


def build_session(app_name: str = "telemetry_lake", **conf: str) -> SparkSession:
    """Create (or get) a session with the job settings; `conf` wins over them.

    Master, memory and executor counts belong to spark-submit and are not set here.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**JOB_CONF, **CREATION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(scan: DataFrame, bytes_per_partition: int = PARTITION_BYTES) -> int:
    """Let shuffles of the scanned rows start with enough partitions to fit in memory.

    The number follows the size of the files behind `scan`, without an upper bound, and
    is never below spark.sql.shuffle.partitions; AQE merges the partitions that turn out
    small. A scan whose size the catalog does not know leaves the setting alone. Classic
    sessions only: the size of a plan is not part of the Connect protocol.
    """
    spark = scan.sparkSession
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size >= int(spark.conf.get("spark.sql.defaultSizeInBytes", str(UNKNOWN_SIZE))):
        return floor
    partitions = max(floor, math.ceil(size / bytes_per_partition))
    spark.conf.set(INITIAL_PARTITIONS, partitions)
    return partitions
