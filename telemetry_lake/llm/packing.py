"""Packing documents into training sequences with lexical neighbours.

1. Documents are encoded once; how many pieces hold each term is counted over all of them.
2. Each piece is named by its strongest BM25 terms under these counts. Pieces go to tasks
   by the strongest, where a term of more tokens than a task's is dealt over several, and
   are sorted there by all of them, so that lexical neighbours of the whole input lie
   together.
3. Each task cuts its documents into shards of bounded size. Whole sequences are cut off
   long documents first; the rest of each document is a piece of its shard. The shard's
   inverted index holds BM25 weights of the pieces' token ids. A window starts with an
   unused piece, the seed; the index returns its unused neighbours by score, and they fill
   the window greedily. A piece that does not fit is cut there, and what is left of it is
   the next seed. So all sequences are full but the last ones of a task, whose pieces go to
   sequences of the powers of two that make up their sum, which need no padding either.

Defined cases: a null or empty text is its end token alone; repeated rows are packed as
often as they come; ties of scores go to the earlier piece; a document of any length is
cut into as many sequences as it takes; an empty table gives no rows; only id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow, stage
from telemetry_lake.llm.tokens import worker_encoder

WINDOW = 4096
END_ID = 2
# Tokens of a shard; its index is held in one task's memory.
SHARD_TOKENS = 1 << 20
# Tokens that go to one task, about.
TASK_TOKENS = 1 << 22
# Tasks at most; beyond that many tokens a task takes more shards, one after the other.
MOST_TASKS = 20_000
# Terms that name a piece.
NAMES = 3
# The usual BM25 parameters.
K1, B = 1.2, 0.75


class Index:
    """Inverted index of a shard's pieces: per term the pieces that have it, with BM25 weights.

    Terms in more than a share `most` of the pieces are not used for retrieval.
    """

    def __init__(self, pieces: list[np.ndarray], most: float = 0.5):
        n = len(pieces)
        counted = [np.unique(piece, return_counts=True) for piece in pieces]
        terms = np.concatenate([t for t, _ in counted])
        counts = np.concatenate([c for _, c in counted]).astype(np.float64)
        owners = np.repeat(np.arange(n), [len(t) for t, _ in counted])
        lengths = np.array([len(piece) for piece in pieces], dtype=np.float64)
        order = np.argsort(terms, kind="stable")
        self.terms, first, df = np.unique(terms[order], return_index=True, return_counts=True)
        self.first = np.append(first, len(terms))
        self.owners = owners[order]
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        weight = counts * (K1 + 1) / (counts + norm[owners])
        self.weights = weight[order] * np.repeat(idf, df)
        # A term in a single piece finds none.
        self.telling = (df > 1) & (df <= max(most * n, 2))
        self.size = n
        # Terms in over half of the pieces have a row of all weights each: no more cells than twice the postings.
        common = np.flatnonzero(self.telling & (2 * df > max(n, 4)))
        self.row = np.full(len(df), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), n))
        for k, term in enumerate(common):
            own = slice(self.first[term], self.first[term + 1])
            self.rows[k, self.owners[own]] = self.weights[own]

    def neighbours(self, query: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """Unused pieces by falling score against the query's distinct terms, then by number."""
        at = np.searchsorted(self.terms, np.unique(query))
        at = at[self.telling[at]]
        common = self.row[at]
        at, common = at[common < 0], common[common >= 0]
        low, many = self.first[at], self.first[at + 1] - self.first[at]
        places = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        scores = np.bincount(self.owners[places], weights=self.weights[places], minlength=self.size)
        scores = scores + self.rows[common].sum(axis=0)
        scores[~unused] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


class Packer:
    """Windows of one task. A piece is (document's row, start in its document, ids, document's tokens)."""

    def __init__(self, window: int):
        self.window = window
        self.open: list[tuple] = []
        self.room = window
        self.sequences = 0

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        rows, offset = [], 0
        for key, start, ids, total in pieces:
            rows.append((key, start, len(ids), ids, total, self.sequences, offset))
            offset += len(ids)
        self.sequences += 1
        return rows

    def _put(self, piece: tuple) -> tuple[list[tuple], tuple | None]:
        """Into the open window; its rows once it is full, and what is left of the piece."""
        key, start, ids, total = piece
        self.open.append((key, start, ids[: self.room], total))
        rest = (key, start + self.room, ids[self.room :], total) if len(ids) > self.room else None
        self.room -= min(len(ids), self.room)
        if self.room:
            return [], None
        rows, self.open, self.room = self._emit(self.open), [], self.window
        return rows, rest

    def shard(self, documents: list[tuple]) -> Iterator[tuple]:
        """Rows of the windows that these (row, ids) fill; the last window stays open."""
        pieces = []
        for key, ids in documents:
            cut = len(ids) // self.window * self.window
            for start in range(0, cut, self.window):
                yield from self._emit([(key, start, ids[start : start + self.window], len(ids))])
            if cut < len(ids):
                pieces.append((key, cut, ids[cut:], len(ids)))
        if not pieces:
            return
        index = Index([ids for _, _, ids, _ in pieces], most=1.0)
        unused = np.ones(len(pieces), dtype=bool)
        queue: Iterator[int] = iter(())
        following = 0
        while True:
            number = next((k for k in queue if unused[k]), None)
            if number is None:
                # No neighbour is left: the next piece in order is a seed of its own.
                while following < len(pieces) and not unused[following]:
                    following += 1
                if following == len(pieces):
                    return
                number = following
                queue = iter(index.neighbours(pieces[number][2], unused & (np.arange(len(pieces)) != number)))
            unused[number] = False
            rows, rest = self._put(pieces[number])
            if rows:
                yield from rows
                queue = iter(())
            if rest is not None:
                # What is left is shorter than a window, as every piece is.
                self._put(rest)
                queue = iter(index.neighbours(rest[2], unused))

    def finish(self) -> Iterator[tuple]:
        """The open window, in sequences of powers of two."""
        left, pieces = self.window - self.room, self.open
        while left:
            size = 1 << (left.bit_length() - 1)
            own, room = [], size
            while room:
                key, start, ids, total = pieces[0]
                own.append((key, start, ids[:room], total))
                pieces = ([(key, start + room, ids[room:], total)] if len(ids) > room else []) + pieces[1:]
                room -= len(own[-1][2])
            yield from self._emit(own)
            left -= size


def _narrow(ids: np.ndarray) -> np.ndarray:
    """Ids in two bytes each if all fit: they are stored and moved like that."""
    return ids.astype("<u2" if ids.max() < 1 << 16 else "<u4")


def _ids(blob: bytes, tokens: int) -> np.ndarray:
    """The ids of a stored document, whose number tells their width."""
    return np.frombuffer(blob, dtype=f"<u{len(blob) // tokens}")


class Distinct:
    """Distinct terms of a piece without sorting it; holds one cell per id met so far."""

    def __init__(self):
        self.place = np.zeros(0, dtype=np.int64)

    def of(self, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms in no order, and how often each is there."""
        if not len(piece):
            return piece, np.zeros(0, dtype=np.int64)
        most = int(piece.max()) + 1
        if most > len(self.place):
            self.place = np.zeros(2 * most, dtype=np.int64)
        # Of all places of a term the one that was written last stands for it.
        self.place[piece] = np.arange(len(piece))
        counts = np.bincount(self.place[piece], minlength=len(piece))
        last = np.flatnonzero(counts)
        return piece[last], counts[last]


def _encoded(texts: DataFrame, tokenizer: str, end_id: int, window: int, kind: str) -> DataFrame:
    """doc_id, ids and tokens of each document, and a row of each task with its `terms` and how many pieces hold them."""

    def work(batches):
        encoder, distinct, df, key_type = worker_encoder(tokenizer), Distinct(), np.zeros(0, dtype=np.int64), None
        for batch in batches:
            key_type = batch.schema.field(0).type
            ids, starts = encoder.encode(batch.column(1).to_pylist())
            own = [_narrow(np.append(ids[a:b], np.uint32(end_id))) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            for piece in own:
                terms, _ = distinct.of(piece[len(piece) // window * window :])
                if len(terms):
                    if len(distinct.place) > len(df):
                        df = np.pad(df, (0, len(distinct.place) - len(df)))
                    df[terms] += 1
            blobs = pa.array([piece.tobytes() for piece in own], pa.binary())
            none = pa.nulls(len(own), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), blobs, pa.array([len(piece) for piece in own], pa.int64()), none, none], names)
        if len(df):
            used = np.flatnonzero(df)
            lists = [pa.array([part.tolist()], pa.list_(pa.int64())) for part in (used, df[used])]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key_type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), *lists], names)

    names = ["doc_id", "ids", "tokens", "terms", "df"]
    return map_arrow(texts, work, f"doc_id {kind}, ids binary, tokens long, terms array<long>, df array<long>")


def strongest(terms: np.ndarray, counts: np.ndarray, length: int, df: np.ndarray, idf: np.ndarray, mean: float) -> list[int]:
    """The NAMES terms of most BM25 weight that other pieces hold too, -1 for want of more; ties to the smaller id."""
    held = df[terms] > 1
    terms, counts = terms[held], counts[held]
    weight = counts * (K1 + 1) / (counts + K1 * (1 - B + B * length / mean)) * idf[terms]
    if len(terms) > NAMES:
        best = np.flatnonzero(weight >= np.partition(weight, -NAMES)[-NAMES])
        terms, weight = terms[best], weight[best]
    best = terms[np.lexsort((terms, -weight))[:NAMES]].tolist()
    return best + [-1] * (NAMES - len(best))


def _by_content(encoded: DataFrame, window: int, kind: str) -> DataFrame:
    """doc_id, ids and tokens, in tasks and sorted by the pieces' strongest terms.

    The names of the pieces are worked out once and stored beside their ids; how many tokens
    a leading term has, and so which tasks it goes to, follows from the stored names.
    """
    spark = encoded.sparkSession
    rows = encoded.where("terms IS NULL").select("doc_id", "ids", "tokens")
    total = rows.agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens")).first()
    documents, tokens = total.documents, total.tokens or 0
    pairs = encoded.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "df")).alias("p")).select("p.terms", "p.df")
    found = pairs.groupBy("terms").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(int(found["terms"].max()) + 1 if len(found) else 1, dtype=np.int64)
    df[found["terms"].to_numpy(dtype=int)] = found["df"].to_numpy(dtype=int)
    # Pieces are shorter than a window; the mean only scales the lengths.
    mean = max(1.0, min(window, tokens / max(1, documents)))
    sent = spark.sparkContext.broadcast(df)
    by = [f"term{k}" for k in range(NAMES)]

    def name(batches):
        df, distinct = sent.value, Distinct()
        idf = np.log1p((documents - df + 0.5) / (df + 0.5))
        for batch in batches:
            stored = (_ids(blob, n) for blob, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            pieces = (ids[len(ids) // window * window :] for ids in stored)
            terms = [strongest(*distinct.of(piece), len(piece), df, idf, mean) for piece in pieces]
            columns = [pa.array([own[k] for own in terms], pa.int64()) for k in range(NAMES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["doc_id", "ids", "tokens", *by])

    named = map_arrow(rows, name, f"doc_id {kind}, ids binary, tokens long, " + ", ".join(f"{n} long" for n in by))
    named = stage(named, "named")
    # One row per term of the tokenizer at most, and one for pieces without a name (-1).
    load = named.groupBy(by[0]).agg(F.sum("tokens").alias("tokens")).toPandas().sort_values([by[0]])
    # -1 comes last, as every other term says more.
    load = load.iloc[np.argsort(load[by[0]].to_numpy() < 0, kind="stable")]
    sizes = load["tokens"].to_numpy(dtype=float)
    task_tokens = max(TASK_TOKENS, tokens / MOST_TASKS)
    first = ((np.cumsum(sizes) - sizes) // task_tokens).astype(np.int64)
    span = np.maximum(1, np.ceil(sizes / task_tokens)).astype(np.int64)
    dealt = spark.createDataFrame(
        list(zip(load[by[0]].tolist(), first.tolist(), span.tolist(), strict=True)), f"{by[0]} long, first long, span long"
    )
    part = (F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("span"))).alias("part")
    placed = named.join(F.broadcast(dealt), by[0]).select("doc_id", "ids", "tokens", part, *by)
    tasks = int((first + span).max()) if len(load) else 1
    ranged = placed.repartition(tasks, "part").sortWithinPartitions("part", *by, "doc_id", "ids")
    return ranged.select("doc_id", "ids", "tokens")


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (32-bit little-endian), doc_tokens, sequence_id, offset.

    `tokenizer` is the path of a tokenizers file that exists on every executor. A
    sequence's id holds the task's partition above its number in that task.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def batch_of(rows: list[tuple], key_type: pa.DataType, base: int) -> pa.RecordBatch:
        key, start, length, ids, total, sequence, offset = zip(*rows, strict=True) if rows else [[]] * 7
        ids = pa.array([own.astype("<u4").tobytes() for own in ids], pa.binary())
        longs = [pa.array(column, pa.int64()) for column in (start, length, total, [base + s for s in sequence], offset)]
        return pa.RecordBatch.from_arrays([pa.array(key, key_type), *longs[:2], ids, *longs[2:]], names)

    def work(batches):
        packer = Packer(window)
        base = TaskContext.get().partitionId() << 40
        held, size, key_type = [], 0, None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, blob, tokens in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                held.append((key, _ids(blob, tokens)))
                size += len(held[-1][1])
                if size >= shard_tokens:
                    yield batch_of(list(packer.shard(held)), key_type, base)
                    held, size = [], 0
        if held:
            yield batch_of(list(packer.shard(held)), key_type, base)
        if packer.open:
            yield batch_of(list(packer.finish()), key_type, base)

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return map_arrow(_by_content(stage(_encoded(texts, tokenizer, end_id, window, kind), "encoded"), window, kind), work, schema)
