"""What the training-data operators share: words, folds, staged tables, Arrow batches."""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.storage import delete, new_work_path

# What separates words in all operators, as a regex class.
WHITE_CLASS = r"[\x20\x09-\x0D]"

# Rows of an Arrow batch handled at once in Python, so that memory follows this and not the batch.
SLICE_ROWS = 512

# The same for its bytes: a slice is cut before it holds more, but for a single longer row.
SLICE_BYTES = 2 << 20


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def stage(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the cluster's shared folder and read back.

    The written table cuts the lineage: a lost executor re-reads a file. It has to
    outlive the lazy result that reads it, so it goes when the driver's Python ends.
    """
    spark = df.sparkSession
    path = new_work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    """Remove a staged table, if the session is still there to do it."""
    try:
        if spark.sparkContext._jsc is not None:
            delete(spark, path)
    except Exception:  # noqa: BLE001  the JVM may have ended first; nothing is lost by that
        return


# Rows of the batches in which texts are read and go to Python. With Spark's defaults of 4 096
# and 10 000 a few long texts make batches, and copies of them, that take a gigabyte.
BATCH_SETTINGS = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


def small_batches(spark: SparkSession) -> None:
    """Let the session read and send at most SLICE_ROWS rows at once; a smaller number stays.

    The setting remains, as results are lazy and read later.
    """
    for name in BATCH_SETTINGS:
        if not 0 < int(spark.conf.get(name)) <= SLICE_ROWS:
            spark.conf.set(name, SLICE_ROWS)


def slices(batches: Iterable[pa.RecordBatch], text_column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most SLICE_ROWS rows and about SLICE_BYTES of the given text column."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and (row - start >= SLICE_ROWS or held + size > SLICE_BYTES):
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def map_arrow(df: DataFrame, work: Callable, schema: str, text_column: int = 1) -> DataFrame:
    """mapInArrow over slices: `work` gets an iterator of bounded record batches."""

    def run(batches):
        return work(slices(batches, text_column))

    return df.mapInArrow(run, schema)
