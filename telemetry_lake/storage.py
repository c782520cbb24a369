"""Shared-folder staging and the few file-system calls the DataFrame API lacks.

These calls go through the JVM, so the jobs need a classic session, not Spark Connect.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Only a local[...] session without one gets a temporary folder: on a cluster a
    machine-local path would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="telemetry_lake_")
    spark.sparkContext.setCheckpointDir(folder)
    return work_dir(spark)


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nobody else uses."""
    return f"{work_dir(spark)}/telemetry_lake/{name}-{uuid.uuid4().hex}"


class Staging:
    """Intermediate tables of one run, written to the shared folder and removed at the end.

    A written table cuts the lineage: losing an executor later re-reads a file
    instead of recomputing the scan and shuffle behind it. Its size is known too.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = new_work_path(spark, "staging")

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        delete(self.spark, self.path)

    def save(self, df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        """`df` as stored; `rows_per_file` bounds the rows of a file, 0 does not."""
        target = f"{self.path}/{name}"
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.mkdirs(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths for a glob pattern; an absent parent gives an empty list."""
    fs, target = _locate(spark, pattern)
    return [status.getPath().toString() for status in (fs.globStatus(target) or [])]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; an absent folder has nothing in it."""
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written aside, then renamed. It must be new."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, target = _locate(spark, aside)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(target, _locate(spark, path)[1]):
        fs.delete(target, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def files_in(spark: SparkSession, folders: Iterable[str]) -> list[str]:
    """All files below the folders, listed by Spark: in tasks where the folders are many."""
    folders = list(folders)
    if not folders:
        return []
    found = spark.read.option("recursiveFileLookup", "true").text(folders)
    return sorted(unquote(file) for file in found.inputFiles())


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)
