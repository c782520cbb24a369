"""Near duplicates: similarity sketches, banding, and verification on full shingle sets.

1. Documents with equal shingle sets are one node, named by a 128-bit digest of the set.
2. A node's sketch is cut into bands; nodes that agree in a band share its bucket.
3. In each bucket all nodes are compared with one pivot, the one of the smallest id. What
   then shares a component needs no more comparing. Where a pivot's nodes still lie in
   several components, those outside of the most frequent one are compared with all, in
   blocks of BLOCK nodes. So no bucket is capped, no link inside one is lost, and no group
   of copies is expanded into rows for all its pairs.
4. Links are confirmed on the full sets and joined into components.

Two documents at the least similarity of 0.8 share no band with a probability of
(1 - 0.8^4)^24 = 3e-6; more similar ones far less often.

Defined cases: a null or empty text has the empty set, is linked with nothing and kept;
rows without an id are linked by equal text only, in the component of an id that has it or
else in none (null), and then kept; repeated rows of one id are returned as often as they
come, in the class of their text; ties go to the smallest id; only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm import bloom
from telemetry_lake.llm.common import map_arrow, stage
from telemetry_lake.llm.components import components
from telemetry_lake.llm.shingles import WordHashes, as_bytes, mix, shingle_sets
from telemetry_lake.llm.sketch import band_keys, sketch

SHINGLE, PERCENT = 5, 80
BAND_ROWS, BANDS = 4, 24
# Nodes of a block: two blocks are compared at once.
BLOCK = 128
# Bytes of a shingle's hash in stored sets: 40 bits, within one pair of sets.
STORED = 5


def _digests(elements: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """128 bits of each set, from two sums over mixed elements; None for the empty set."""
    sizes = np.diff(starts)
    out: list[bytes | None] = [None] * len(sizes)
    full = np.flatnonzero(sizes)
    if len(full):
        sums = [np.add.reduceat(mix(elements ^ np.uint64(seed)), starts[:-1][full]) for seed in (0x5851F42D, 0x14057B7E)]
        pair = np.column_stack([mix(sums[0] + sizes[full].astype(np.uint64)), mix(sums[1])]).astype(">u8")
        for row, digest in zip(full, pair, strict=True):
            out[row] = digest.tobytes()
    return out


def sketched(
    docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", pos_col: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, node, bands, the text's key and the row's place (0 if not given) of every whole text."""
    pos = F.lit(0).cast("long") if pos_col is None else F.col(pos_col)
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("key"), pos.alias("pos")
    )
    kind = texts.schema["doc_id"].dataType.simpleString()

    def work(batches):
        cache = WordHashes()
        for batch in batches:
            elements, starts = shingle_sets(as_bytes(batch.column(1)), size, cache)
            keys = band_keys(sketch(elements, starts, BANDS * BAND_ROWS), BAND_ROWS).view(np.int64)
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array(_digests(elements, starts), pa.binary()), bands, batch.column(2), batch.column(3)],
                ["doc_id", "n_shingles", "node", "bands", "key", "pos"],
            )

    return map_arrow(texts, work, f"doc_id {kind}, n_shingles long, node binary, bands array<long>, key binary, pos long")


def text_key(text: Column) -> Column:
    """128 bits that, beside the id, name a row; rows of one id and text are repeated ones."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _stored_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set) of the documents that stand for a node: each set sorted, STORED bytes a shingle.

    A Bloom filter of bounded size spares most other documents the work; the join is exact.
    """
    key = F.xxhash64(F.col(id_col))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), key.alias("key"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    bits = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted.select(F.xxhash64("rep").alias("key")), "key"))

    def work(batches):
        cache = WordHashes()
        for batch in batches:
            near = bloom.might_contain(bits.value, batch.column(2).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(near))
            elements, starts = shingle_sets(as_bytes(batch.column(1)), size, cache)
            nodes = _digests(elements, starts)
            short = (elements & np.uint64((1 << 8 * STORED) - 1)).astype("<u8")
            sets = []
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                own = np.sort(short[first:last])
                sets.append(own.view(np.uint8).reshape(-1, 8)[:, :STORED].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["rep", "node", "words"]
            )

    stored = map_arrow(texts, work, f"rep {kind}, node binary, words binary").where("node IS NOT NULL")
    return stored.join(wanted.select("node", "rep").distinct(), ["node", "rep"]).dropDuplicates(["node"]).select("node", "words")


def _load(words: bytes) -> np.ndarray:
    raw = np.frombuffer(words, dtype=np.uint8).reshape(-1, STORED)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, :STORED] = raw
    return wide.view("<u8").ravel()


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def work(batches):
        for batch in batches:
            similar = []
            last, one = None, None
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if x != last:  # neighbours often share their pivot
                    last, one = x, _load(x)
                both = np.sort(np.concatenate([one, _load(y)]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                similar.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(similar, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = sets.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
    return map_arrow(joined, work, "a binary, b binary", text_column=3)


def classes(rows: DataFrame, docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, root) for all nodes that are linked with another."""
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    placed = nodes.where("rep IS NOT NULL").select("node", "rep", "n", F.explode("bands").alias("band"))
    pivots = placed.groupBy("band").agg(F.min(F.struct("rep", "node", "n")).alias("pivot"), F.count("*").alias("many"))
    members = placed.join(pivots.where("many > 1"), "band")
    members = members.select("node", "rep", "n", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n"))
    members = stage(members.distinct(), "members")
    sets = stage(_stored_sets(docs, members.select("node", "rep").distinct(), size, id_col, text_col), "sets")
    sizes = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")
    star = members.where((F.col("node") != F.col("pivot")) & sizes)
    links = stage(_compared(star.select(F.col("pivot").alias("a"), F.col("node").alias("b")), sets, percent), "links")
    return components(links.union(_left_over(members, sets, components(links), percent)))


def _left_over(members: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of one pivot that lie in two components so far."""
    rooted = members.join(found, "node", "left").select("pivot", "node", "n", F.coalesce("root", "node").alias("root"))
    counted = rooted.groupBy("pivot", "root").agg(F.count("*").alias("many"))
    main = counted.groupBy("pivot").agg(
        F.max(F.struct("many", "root")).alias("main"), F.sum("many").alias("all"), F.count("*").alias("roots")
    )
    # Written, so that the join that follows deals both sides anew and can split a frequent pivot.
    main = main.where("roots > 1 AND all > 2").select("pivot", F.col("main.root").alias("main"), "main.many", "all")
    main = stage(main, "unsettled")
    # The pivot itself has met all of the others.
    unsettled = rooted.where("node <> pivot").join(main, "pivot").withColumn("stray", F.col("root") != F.col("main"))
    of_kind = F.when(F.col("stray"), F.col("all") - F.col("many")).otherwise(F.col("many"))
    block = F.pmod(F.xxhash64("node"), F.ceil(of_kind / BLOCK)).alias("block")
    filled = unsettled.select("pivot", "stray", block, "node", "root").join(sets, "node")
    blocks = filled.groupBy("pivot", "stray", "block").agg(F.collect_list(F.struct("node", "root", "words")).alias("own"))
    blocks = stage(blocks, "blocks")
    x = blocks.where("stray").select("pivot", F.col("block").alias("x_block"), F.col("own").alias("x"))
    y = blocks.select("pivot", "stray", F.col("block").alias("y_block"), F.col("own").alias("y"))
    paired = x.join(y, "pivot").where("NOT stray OR x_block <= y_block").select("x", "y")

    def work(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(_similar(batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), percent))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], ["a", "b"]
                )

    return paired.mapInArrow(work, "a binary, b binary")


def _similar(x: list[dict], y: list[dict], percent: int):
    """Similar pairs between two blocks, of different roots: shared shingles are counted for all of x at once."""
    sets = [_load(one["words"]) for one in x]
    sizes = np.array([len(own) for own in sets])
    words = np.concatenate(sets)
    order = np.argsort(words, kind="stable")
    words, owners = words[order], np.repeat(np.arange(len(x)), sizes)[order]
    roots = np.array([one["root"] for one in x], dtype=object)
    for other in y:
        own = _load(other["words"])
        low, high = np.searchsorted(words, own, "left"), np.searchsorted(words, own, "right")
        many = high - low
        places = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(owners[places], minlength=len(x))
        similar = 100 * shared >= percent * (sizes + len(own) - shared)
        for k in np.flatnonzero(similar & (roots != other["root"])):
            yield x[k]["node"], other["node"]


def _labelled(
    docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, pos_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The sketched rows; and doc_id, key, n_shingles, component_id and best of those with words.

    `best` names the row that stands for the component: the smallest (doc_id, node, key) of
    its rows with an id.
    """
    rows = stage(sketched(docs, size, id_col, text_col, pos_col), "sketches")
    own = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "node", "key"))).alias("own")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), own)
    linked = classes(rows, docs, size, percent, id_col, text_col).join(nodes, "node")
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"), F.min("own").alias("best"))
    linked = stage(linked.join(least, "root").select("node", "component_id", "best"), "linked")
    named = nodes.join(linked, "node", "left")
    named = named.select("node", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("best", "own").alias("best"))
    return rows, rows.where("node IS NOT NULL").join(stage(named, "named"), "node")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach) and kept, for every row."""
    rows, labelled = _labelled(docs, size, percent, id_col, text_col)
    out = labelled.select("doc_id", "n_shingles", "component_id")
    # Rows without words would all meet under one null key, so they stay out of the joins.
    alone = rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.union(alone).select("doc_id", "n_shingles", "component_id", kept)


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near copies, with its own columns.

    Rows decide, not ids: of the rows with an id in a component the one of the smallest id,
    then digest, stays, and another text under the id of a copy stays too. Of rows that
    repeat both id and text one stays, and of rows without an id one for each text that no
    row with an id has. Documents without words stay, but for such repeats.

    Texts are written once with a number for each row and joined once with the numbers that
    stay; what decides moves without them.
    """
    pos = next(name for k in range(len(docs.columns) + 1) if (name := "_pos" + "_" * k) not in docs.columns)
    numbered = stage(docs.withColumn(pos, F.monotonically_increasing_id()), "numbered")
    rows, labelled = _labelled(numbered, size, percent, "doc_id", "text", pos)
    first = F.min("pos").alias("pos")
    lost = F.struct("doc_id", "node", "key") != F.col("best")
    copies = labelled.where(F.col("doc_id").isNotNull() & lost).select("doc_id", "key").distinct()
    with_id = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "key").agg(first)
    without = rows.where("doc_id IS NULL").groupBy("key").agg(first).join(with_id.select("key"), "key", "left_anti")
    stays = with_id.join(copies, ["doc_id", "key"], "left_anti").select("pos").union(without.select("pos"))
    kept = numbered.join(stays.withColumnRenamed("pos", pos), pos, "left_semi")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
