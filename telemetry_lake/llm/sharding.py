"""Documents into shards by best-fit-decreasing bin packing; equal texts stay together.

A group is all rows of one text; its size is the sum over its rows of the text's UTF-8
bytes plus one. Groups are taken by decreasing size, and each goes into the shard with the
least remaining room that still holds it, which a balanced tree over the remaining rooms
finds. With a given capacity a shard is opened when no open one has room; with a given
number of shards the capacity is the least that the packing was found to need.

Groups of one size are interchangeable, so what is packed is a table of sizes with the
number of groups of each: a run of equal groups fills the tightest shard as far as it goes,
then the next, just as one by one. Sizes are rounded up to 17 significant bits for that
(exact below 131 072 bytes, by less than 1/65 536 beyond), so the table has at most three
million rows at any volume, and far fewer in practice. Which group of a size goes where
follows from its rank, worked out in Spark.

Defined cases: a null text counts as the empty one, so all of these are one group; repeated
rows and repeated ids are rows of their own, kept all; a group of more than its even share
has a shard of its own and the others share the rest evenly; fewer groups than shards leave
shards empty; an empty table gives no rows. Columns `shard` and `slot` of the input are
replaced, all others are kept as they are.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.common import stage

# Significant bits of a size in the packing; sets the largest number of different sizes.
SIZE_BITS = 17
# A group with more than this share of the rows is hot. There are at most so many, 4 MB.
HOT_GROUPS = 100_000
# A group of fewer rows burdens no task.
HOT_COPIES = 1_000
# Groups of one size that one task ranks.
RANKED_GROUPS = 1 << 18


class RoomTree:
    """A set of whole numbers with the least member that is not below a value.

    A tree of fixed height: each node holds 64 bits, one per child that is not empty.
    """

    def __init__(self, top: int):
        self.levels: list[dict[int, int]] = [defaultdict(int) for _ in range(max(1, -(-top.bit_length() // 6)))]

    def add(self, value: int) -> None:
        for level in self.levels:
            level[value >> 6] |= 1 << (value & 63)
            value >>= 6

    def remove(self, value: int) -> None:
        for level in self.levels:
            level[value >> 6] &= ~(1 << (value & 63))
            if level[value >> 6]:
                return
            del level[value >> 6]
            value >>= 6

    def ceiling(self, value: int) -> int | None:
        for height, level in enumerate(self.levels):
            bits = level.get(value >> 6, 0) >> (value & 63) << (value & 63)
            if bits:
                value = value >> 6 << 6 | (bits & -bits).bit_length() - 1
                for lower in reversed(self.levels[:height]):
                    value = value << 6 | (lower[value] & -lower[value]).bit_length() - 1
                return value
            value = (value >> 6) + 1
        return None


def best_fit(runs: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int]] | None:
    """(groups, shard) in the order of the runs (size, groups), which come by decreasing size.

    A group larger than the capacity gets a shard of its own. None if more than `most`
    shards would be needed. Among shards of the same room the first one opened is taken.
    """
    tree, shards_of = RoomTree(capacity), defaultdict(list)
    out: list[tuple[int, int]] = []
    opened = 0
    for size, groups in runs:
        while groups:
            room = tree.ceiling(size) if size <= capacity else None
            if room is None:
                if opened == most:
                    return None
                shard, room, opened = opened, max(capacity, size), opened + 1
            else:
                shard = heapq.heappop(shards_of[room])
                if not shards_of[room]:
                    del shards_of[room]
                    tree.remove(room)
            taken = min(groups, room // size)
            groups -= taken
            out.append((taken, shard))
            if left := room - taken * size:
                if left not in shards_of:
                    tree.add(left)
                heapq.heappush(shards_of[left], shard)
    return out


def even_fit(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """As `best_fit`, into a number of shards of about the same load.

    Groups over their even share come first, one to a shard. For the rest the capacity
    starts at the even share and grows until the packing needs no more shards; it ends at
    the latest with the even share and one group more.
    """
    total, alone = sum(size * groups for size, groups in runs), []
    runs = [list(run) for run in runs if run[1]]
    while runs and len(alone) < shards - 1 and runs[0][0] * (shards - len(alone)) > total:
        alone.append((1, len(alone)))
        total -= runs[0][0]
        runs[0][1] -= 1
        if not runs[0][1]:
            runs.pop(0)
    if not runs:
        return alone
    left = shards - len(alone)
    least, slack = max(-(-total // left), runs[0][0]), 0
    while (packed := best_fit(runs, least + slack, left)) is None:
        slack = 2 * slack or 1
    return alone + [(groups, len(alone) + shard) for groups, shard in packed]


def _rounded(size: str) -> Column:
    """Rounded up to SIZE_BITS significant bits."""
    drop = f"greatest(0, length(bin({size})) - {SIZE_BITS})"
    return F.expr(f"shiftleft(shiftright({size} + shiftleft(1L, {drop}) - 1, {drop}), {drop})")


def _ranked(groups: DataFrame) -> DataFrame:
    """Groups with their rank among those of the same rounded size.

    One size may hold all groups, so it is ranked in buckets: the groups before a bucket
    are counted, those inside are numbered.
    """
    buckets = 1 + groups.count() // RANKED_GROUPS
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    before = Window.partitionBy("rounded").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = groups.groupBy("rounded", "bucket").agg(F.count("*").alias("n"))
    counts = counts.select("rounded", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("rounded", "bucket").orderBy("key")) - 1
    ranked = groups.withColumn("inside", inside).join(counts, ["rounded", "bucket"])
    return ranked.select("key", "copies", "rounded", (F.col("before") + F.col("inside")).alias("rank"))


def _placed(groups: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """(key, copies, shard) of every group."""
    sizes = groups.groupBy("rounded").agg(F.count("*").alias("n")).toPandas().sort_values("rounded", ascending=False)
    runs = list(zip(sizes["rounded"].tolist(), sizes["n"].tolist(), strict=True))
    packed = even_fit(runs, shards) if capacity is None else best_fit(runs, capacity)
    taken = np.array([n for n, _ in packed], dtype=np.int64)
    negative = -sizes["rounded"].to_numpy()  # ascending, as searchsorted wants it
    shared = groups.sparkSession.sparkContext.broadcast(
        (negative, np.cumsum(sizes["n"].to_numpy()) - sizes["n"].to_numpy(), np.cumsum(taken), np.array([s for _, s in packed], dtype=np.int32))
    )

    def work(batches):
        negative, first, ends, shard = shared.value
        for batch in batches:
            rounded, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            order = first[np.searchsorted(negative, -rounded)] + rank
            found = shard[np.searchsorted(ends, order, "right")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["key", "copies", "shard"])

    return _ranked(groups).mapInArrow(work, "key binary, copies long, shard int")


def _with_shard(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """(pos, part, shard): rows of hot groups find their shard by a broadcast, the others by a join."""
    copies = max(HOT_COPIES, rows.count() // HOT_GROUPS)
    hot = F.broadcast(placed.where(F.col("copies") > copies).select("key", "shard"))
    rows = rows.select("key", "pos", "part")
    cold = rows.join(hot.select("key"), "key", "left_anti").join(placed.where(F.col("copies") <= copies), "key")
    columns = ["pos", "part", "shard"]
    return rows.join(hot, "key").select(*columns).unionByName(cold.select(*columns))


def _slots(sharded: DataFrame) -> DataFrame:
    """(pos, shard, slot): rows of a shard numbered from 0, by the written parts they lie in."""
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = sharded.groupBy("shard", "part").agg(F.count("*").alias("n"))
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("pos")) - 1
    numbered = sharded.withColumn("inside", inside).join(counts, ["shard", "part"])
    return numbered.select("pos", "shard", (F.col("before") + F.col("inside")).alias("slot"))


def shard(docs: DataFrame, shards: int | None = None, capacity: int | None = None, text_col: str = "text") -> DataFrame:
    """The documents with their shard (from 0) and their slot in it (gapless from 0).

    Give either a number of `shards` of about the same size or the `capacity` of a shard in
    bytes, of which as few as best fit needs are used. Texts are written once and joined
    once with their place, by row; everything between moves rows without their texts.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either a number of shards or a capacity")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.monotonically_increasing_id().alias("pos"),
    )
    rows = stage(rows.withColumn("part", F.shiftright("pos", 33)), "shard-rows")
    groups = rows.groupBy("key").agg(F.count("*").alias("copies"), F.sum("size").alias("bytes"))
    groups = stage(groups.select("key", "copies", _rounded("bytes").alias("rounded")), "shard-groups")
    placed = stage(_placed(groups, shards, capacity), "shard-placed")
    slots = _slots(stage(_with_shard(rows, placed), "shard-places"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    return rows.select("row", "pos").join(slots, "pos").select(*kept, "shard", "slot")


def write_shards(sharded: DataFrame, path: str, file_format: str = "parquet") -> None:
    """One folder per shard, its files in the order of the slots; a large shard is several files."""
    ranged = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").format(file_format).save(path)
