"""The data-quality gate: duplicate, null and range flags, then the clean/quarantine split.

A duplicate is any report whose key occurs more than once; every copy is bad. Counting
over a window would move each whole row and put all copies of a key into one task, which
one hot key can make a third of the table. Here the keys are counted first, with map-side
combine, and only the repeated ones are joined back:

* `mark_suspects` and `settle_suspects`, the way of the jobs: a broadcast of at most HOT_KEYS
  of the most frequent keys flags their rows, a blocked filter of all repeated keys, of
  bounded size, clears nearly all others, and both stay where they are. Only rows that may
  be copies are shuffled to the keys. The first result is stored in between.
* `flag_duplicates`, in one plan: by broadcast where the caller says the keys are few, else
  all rows are shuffled to the keys, but those of the most frequent keys are spread.

A key left out of the frequent ones has fewer than HOT_COPIES rows or at most 1/HOT_KEYS of
all: 1 GB at 100 TB, which is one task's share of the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.rules import (
    REPORT_KEY,
    REQUIRED_COLUMNS,
    SENSOR_RULES,
    RangeRule,
    null_flag,
    range_flag,
)
from telemetry_lake.schemas import RAW_LINE

FLAGS = ("_dup", "_null", "_range", "_is_bad")

# Size bound of the broadcast of frequent keys, of about 100 bytes each: 10 MB.
HOT_KEYS = 100_000
# Blocks of 64 bits of the filter, at most that many rows of 16 bytes. At 5 million repeated
# keys one other row in 200 passes, at 30 million one in 4; beyond, more are shuffled, none is lost.
FILTER_BLOCKS = 1 << 20
# Bits a key sets in its block.
FILTER_BITS = 4
# A key with fewer rows than this burdens no task, so it need not compete for that list.
HOT_COPIES = 1_000


def duplicate_keys(df: DataFrame, key: Sequence[str] = REPORT_KEY) -> DataFrame:
    """The keys that occur more than once, with their number of copies.

    Nulls group together, as they do in a window partition.
    """
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def flag_duplicates(
    df: DataFrame,
    key: Sequence[str] = REPORT_KEY,
    keys: DataFrame | None = None,
    keys_are_few: bool = False,
) -> DataFrame:
    """Add `_dup`: the row's key occurs more than once in `df`.

    `keys` may hand in a stored result of `duplicate_keys(df, key)`; `keys_are_few`
    says the caller has checked that they can be broadcast.
    """
    keys = duplicate_keys(df, key) if keys is None else keys
    if keys_are_few:
        marked = _mark(df, F.broadcast(keys), key, "_dup")
        return marked.withColumn("_dup", F.coalesce("_dup", F.lit(False)))

    rows = _mark(df, F.broadcast(_hottest(keys)), key, "_hot")
    # A hot row needs no partner any more. Its scan partition number takes the place of
    # the 0 that the keys carry, which spreads the copies and is the same on a task retry.
    rows = rows.withColumn("_spread", F.when(F.col("_hot"), F.spark_partition_id() + 1).otherwise(0))
    rows = _mark(rows, keys.withColumn("_spread", F.lit(0)), (*key, "_spread"), "_dup")
    return rows.withColumn("_dup", F.coalesce("_hot", "_dup", F.lit(False))).drop("_hot", "_spread")


def _hottest(keys: DataFrame) -> DataFrame:
    return keys.where(F.col("copies") >= HOT_COPIES).orderBy(F.desc("copies")).limit(HOT_KEYS)


def _filter_cell(key: Sequence[str], blocks: int) -> dict[str, Column]:
    """The block of a key and its bits there, from two halves of one hash."""
    digest = F.xxhash64(*key)
    places = [F.shiftrightunsigned(digest, 32 + 6 * k).bitwiseAND(63).cast("int") for k in range(FILTER_BITS)]
    bits = reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places])
    return {"_block": F.pmod(digest, F.lit(blocks)), "_bits": bits}


def mark_suspects(df: DataFrame, key: Sequence[str], keys: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Add `_dup` where it can be told without a shuffle: true for frequent keys, false for what
    the filter rules out, null for rows that may be copies. `keys` is stored, as it is read thrice.
    """
    cells = keys.withColumns(_filter_cell(key, blocks)).groupBy("_block").agg(F.bit_or("_bits").alias("_mask"))
    rows = _mark(df, F.broadcast(_hottest(keys)), key, "_hot").withColumns(_filter_cell(key, blocks))
    rows = rows.join(F.broadcast(cells), "_block", "left")
    possible = F.coalesce(F.col("_mask").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    return rows.withColumn("_dup", F.when(F.col("_hot"), True).when(~possible, False)).drop("_block", "_bits", "_mask", "_hot")


def suspects(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("_dup").isNull())


def settle_suspects(marked: DataFrame, key: Sequence[str], keys: DataFrame) -> DataFrame:
    """The rows that may be copies, with `_dup` settled by a join with the keys; no others are moved."""
    joined = _mark(suspects(marked).drop("_dup"), keys, key, "_dup")
    return joined.withColumn("_dup", F.coalesce("_dup", F.lit(False)))


def _mark(df: DataFrame, keys: DataFrame, key: Sequence[str], flag: str) -> DataFrame:
    """Left join to unique keys, null-safe; `flag` is true for a match and null otherwise."""
    renamed = keys.select(*(F.col(c).alias(f"_key_{c}") for c in key), F.lit(True).alias(flag))
    condition = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key]
    return df.join(renamed, condition, "left").drop(*(f"_key_{c}" for c in key))


def dq_gate(
    df: DataFrame,
    rules: Iterable[RangeRule] = SENSOR_RULES,
    required: Iterable[str] = REQUIRED_COLUMNS,
    key: Sequence[str] = REPORT_KEY,
    keys: DataFrame | None = None,
    keys_are_few: bool = False,
) -> DataFrame:
    """Add the flags `_dup`, `_null`, `_range` and the verdict `_is_bad`; none is ever null."""
    return with_verdict(flag_duplicates(df, key, keys, keys_are_few), rules, required)


def with_verdict(
    flagged: DataFrame, rules: Iterable[RangeRule] = SENSOR_RULES, required: Iterable[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """Add `_null`, `_range` and `_is_bad` to rows that have `_dup`."""
    flagged = flagged.withColumns({"_null": null_flag(required), "_range": range_flag(rules)})
    return flagged.withColumn("_is_bad", F.col("_dup") | F.col("_null") | F.col("_range"))


def clean(flagged: DataFrame) -> DataFrame:
    """Good rows without the flags and without the time text, which event_ts replaces."""
    return flagged.where(~_bad()).drop(*FLAGS, "timestamp", RAW_LINE)


def quarantine(flagged: DataFrame) -> DataFrame:
    """Bad rows without the flags, with the time text as received."""
    return flagged.where(_bad()).drop(*FLAGS)


def _bad() -> Column:
    return F.col("_is_bad")
