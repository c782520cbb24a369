"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

A region that matches an item of m characters with at most e edits shares at least
m + 1 - q (e + 1) of its q-grams, all on e + 1 neighbouring diagonals. So hits are
counted per item in bands of diagonals, each overlapping the next by half, and only
bands with enough hits are aligned. Both sides are compared in lower case, with white
space as single spaces; e is a tenth of the item's length, or what the lemma still can
tell for a short item.

The benchmark is the stated query set: it goes to all documents in blocks of bounded
size. A task holds one block; the driver holds one while it builds it, and in `contaminated`
the broadcasts of all blocks stay until its result is read.

Defined cases: null and empty texts and items, and items shorter than q characters,
match nothing; texts are searched whole; repeated rows are searched row by row, repeated
items each by their id; empty tables give no rows; only id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from telemetry_lake.llm.common import map_arrow, stage

Q = 8
EDIT_RATE = 0.1
# Characters of the benchmark that are searched for at once.
BLOCK_CHARS = 4 << 20
# Characters of texts that are searched at once; a longer text is searched in overlapping pieces.
PIECE_CHARS = 1 << 18
# Bits of the table that tells most q-grams of texts apart from those of items.
TABLE_BITS = 22
# Fixed value: start of the multipliers of the q-gram hash.
SEED = 0x9E3779B97F4A7C15


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces; NUL, which parts documents, is a space too."""
    text = (text or "").replace("\0", " ").lower()
    if len(text) <= PIECE_CHARS:
        return " ".join(text.split())
    # In parts, as the list of a long text's words takes ten times its size.
    out, spaced = [], False
    for start in range(0, len(text), PIECE_CHARS):
        part = text[start : start + PIECE_CHARS]
        spaced = spaced or part[0].isspace()
        if words := " ".join(part.split()):
            out += [" ", words] if spaced and out else [words]
            spaced = part[-1].isspace()
    return "".join(out)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q characters in a row, q a power of two: halves are joined in turn."""
    total, length, multiplier = chars.astype(np.uint64), 1, SEED
    while length < q:
        if len(total) <= length:
            return np.zeros(0, dtype=np.uint64)
        total = total[:-length] * np.uint64(multiplier) + total[length:]
        total ^= total >> np.uint64(31)
        length, multiplier = 2 * length, multiplier * SEED & 0xFFFFFFFFFFFFFFFF | 1
    return total * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Index:
    """The q-grams of a block of items, sorted by hash, with the least number of shared ones."""

    ids: list
    chars: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    q: int

    @classmethod
    def of(cls, items: list[tuple], q: int = Q, rate: float = EDIT_RATE) -> Index:
        kept = [(i, c) for i, text in items if len(c := codes(normal(text))) >= q]
        sizes = np.array([len(c) for _, c in kept], dtype=np.int64)
        edits = np.minimum((sizes * rate).astype(np.int64), (sizes - q) // q)
        grams = [gram_hashes(c, q) for _, c in kept]
        hashes = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        item = np.repeat(np.arange(len(kept)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, dtype=np.int64)
        order = np.argsort(hashes, kind="stable")
        table = np.zeros(1 << TABLE_BITS, dtype=bool)
        table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        least = sizes + 1 - q * (edits + 1)
        return cls([i for i, _ in kept], [c for _, c in kept], edits, least, hashes[order], item[order], place[order], table, q)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [low, high): the number of the range and the place, of every place in them."""
    many = high - low
    owner = np.repeat(np.arange(len(low)), many)
    return owner, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[owner]


def candidates(index: Index, chars: np.ndarray, starts: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Per item, the first diagonals of the bands with enough hits in the joined texts."""
    hashes = gram_hashes(chars, index.q)
    near = np.flatnonzero(index.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    wanted = hashes[near]
    low, high = np.searchsorted(index.hashes, wanted, "left"), np.searchsorted(index.hashes, wanted, "right")
    owner, found = _expand(low, high)
    at, item, place = near[owner], index.item[found], index.place[found]
    # Too few hits in the whole text rule an item out before its diagonals are looked at.
    cell = (np.searchsorted(starts, at, "right") - 1) * len(index.ids) + item
    _, which, shared = np.unique(cell, return_inverse=True, return_counts=True)
    enough = shared[which] >= index.least[item]
    at, item, place = at[enough], item[enough], place[enough]
    width = index.edits[item] + 1
    # Diagonals may be negative at the start; the shift keeps all bands non-negative.
    band = (at - place + len(chars)) // width
    span = 2 * len(chars) + 2
    keys, counts = np.unique(np.concatenate([item * span + band, item * span + band - 1]), return_counts=True)
    items, bands = keys // span, keys % span
    good = counts >= index.least[items]
    out = []
    for one in np.unique(items[good]):
        out.append((int(one), bands[good & (items == one)] * (index.edits[one] + 1) - len(chars)))
    return out


def align(item: np.ndarray, chars: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the item against regions that start on diagonals first .. first + width, and where they end.

    One row of cells per candidate, one column per diagonal, all candidates at once; the
    text outside of `chars` matches nothing.
    """
    columns = np.arange(width)
    cells = np.zeros((len(first), width), dtype=np.int32)
    padded = np.concatenate([chars, [0xFFFFFFFF]]).astype(np.int64)
    for i, char in enumerate(item):
        at = first[:, None] + columns[None, :] + i
        inside = (at >= 0) & (at < len(chars))
        replaced = cells + (padded[np.where(inside, at, len(chars))] != char)
        dropped = np.full_like(cells, len(item) + width)
        dropped[:, :-1] = cells[:, 1:] + 1
        best = np.minimum(replaced, dropped)
        cells = (np.minimum.accumulate(best - columns, axis=1) + columns).astype(np.int32)
    column = cells.argmin(axis=1)
    return cells[np.arange(len(first)), column], first + column + len(item)


def matches(index: Index, texts: list[str | None]) -> list[tuple[int, object, int, int, int]]:
    """(text number, item id, edits, start, length) of the best region of each item in each text.

    Start and length are in characters of the normalised text; of equally good regions
    the one that ends first counts, and of its starts the last. Texts are searched in pieces
    that overlap by more than any region, a bounded number of characters at once.
    """
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for owners, offsets, pieces in _pieces(index, texts):
        for piece, item, cost, end, length in _regions(index, pieces):
            key, end = (owners[piece], item), end + offsets[piece]
            if key not in best or (cost, end) < best[key][:2]:
                best[key] = (cost, end, length)
    return [(owner, index.ids[item], cost, end - length, length) for (owner, item), (cost, end, length) in sorted(best.items())]


def _pieces(index: Index, texts: list[str | None]):
    """Lots of pieces of normalised texts, with the number of the text and the place in it."""
    if not index.ids:
        return
    # A region, and what its alignment looks at to either side.
    overlap = int(max(len(c) + 4 * (e + 1) for c, e in zip(index.chars, index.edits.tolist(), strict=True))) + index.q
    step = max(PIECE_CHARS, 4 * overlap)
    owners, offsets, pieces, held = [], [], [], 0
    for owner, text in enumerate(texts):
        text = normal(text)
        for offset in range(0, max(1, len(text) - overlap), step):
            owners.append(owner)
            offsets.append(offset)
            pieces.append(text[offset : offset + step + overlap])
            held += len(pieces[-1])
            if held >= step:
                yield owners, offsets, pieces
                owners, offsets, pieces, held = [], [], [], 0
    if pieces:
        yield owners, offsets, pieces


def _regions(index: Index, normalised: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(piece, item's number, edits, end, length) of the best region of each item in each piece."""
    joined = codes("\0".join(normalised) + "\0" * index.q)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in normalised])[:-1]]).astype(np.int64)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for item, first in candidates(index, joined, starts):
        chars, edits = index.chars[item], int(index.edits[item])
        whole = chars.tobytes().decode("utf-32-le", "surrogatepass")
        middle = np.clip(first + edits + 1 + len(chars) // 2, 0, len(joined) - 1)
        for owner in np.unique(numbers := np.searchsorted(starts, middle, "right") - 1):
            begin = starts[owner]
            if (exact := normalised[owner].find(whole)) >= 0:  # nothing can be better
                best[(int(owner), item)] = (0, exact + len(chars))
                continue
            own = joined[begin : begin + len(normalised[owner])]
            # The band and an edit budget to each side.
            cost, end = align(chars, own, first[numbers == owner] - begin - edits, 2 * (edits + 1) + 2 * edits)
            k = np.lexsort((end, cost))[0]
            if cost[k] <= edits and (found := (int(cost[k]), int(min(end[k], len(own))))) < best.get((owner, item), (edits + 1,)):
                best[(int(owner), item)] = found
    out = []
    for (owner, item), (cost, end) in sorted(best.items()):
        begin = starts[owner]
        length = _length(index.chars[item][::-1], joined[begin : begin + end][::-1], cost)
        out.append((owner, item, cost, end, length))
    return out


def _length(item: np.ndarray, chars: np.ndarray, cost: int) -> int:
    """Shortest beginning of `chars` that the item matches with `cost` edits; one exists."""
    top = len(item) + cost + 1
    columns = np.arange(top + 1)
    chars = np.concatenate([chars[:top].astype(np.int64), np.full(max(0, top - len(chars)), -1)])
    cells = columns.copy()
    for i, char in enumerate(item):
        best = np.concatenate([[i + 1], np.minimum(cells[:-1] + (chars != char), cells[1:] + 1)])
        cells = np.minimum.accumulate(best - columns) + columns
    return int(np.flatnonzero(cells <= cost)[0])


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", chars: int = BLOCK_CHARS):
    """The benchmark's items in blocks of about `chars` characters, one after the other."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("length(text) > 0").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // chars)
    for number in range(count):  # of a repeated item one row is enough
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == number).collect()
        yield Index.of(sorted(((row.id, row.text) for row in own), key=repr))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = BLOCK_CHARS
) -> DataFrame:
    """doc_id, item_id, edits, start and length of the best region of each item that a document contains."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [texts.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, edits int, start long, length long"
    types = [to_arrow_type(benchmark.schema["item_id"].dataType), pa.int32(), pa.int64(), pa.int64()]
    found = docs.sparkSession.createDataFrame([], schema)
    for index in blocks(benchmark, chars=chars):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        def work(batches, shared=shared):
            index = Index(**shared.value)
            for batch in batches:
                rows = matches(index, batch.column(1).to_pylist())
                own = batch.column(0).take(pa.array([row[0] for row in rows], pa.int64()))
                columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(types, 1)]
                yield pa.RecordBatch.from_arrays([own, *columns], ["doc_id", "item_id", "edits", "start", "length"])

        found = found.union(map_arrow(texts, work, schema))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without any benchmark item, with their own columns; no shuffle, one pass per block.

    What one block leaves is written before the next, so that a task holds one block only.
    """
    left, place = docs, docs.columns.index("text")
    for number, index in enumerate(blocks(benchmark, chars=chars)):
        left = stage(left, "left") if number else left
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        def work(batches, shared=shared):
            index = Index(**shared.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row[0] for row in matches(index, batch.column(place).to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        left = map_arrow(left, work, left.schema, place)
    return left
