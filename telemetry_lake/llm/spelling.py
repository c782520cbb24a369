"""Spelling variants: words that differ by one edit, found by PartEnum signatures.

A word is taken as the multiset of its letters, written as a binary vector with one
dimension for the first, second, ... copy of each letter. An edit changes at most two
dimensions: a replaced letter exactly two and no length, an inserted or deleted one exactly
one. The dimensions are dealt over PARTS partitions, frequent ones evenly. Vectors at a
distance of k agree in all partitions but k at most, so every choice of PARTS - k of them
is one signature, and two near words share one. Replacements are sought among words of the
same length with k = 2, insertions between neighbouring lengths with k = 1. Signatures are
equi-joined and the pairs verified, first by the hash of one half of the word (an edit
leaves the half before it or the one behind it alone), then by the edit distance.

A signature of more than BUCKET words is refined: its words are joined by the signature and
either half, which loses no pair of near words and never lists all pairs of the signature.

Defined cases: null and empty texts have no words; a null id counts as the empty text in the
hash; a word is never near itself; of equally frequent near words the smallest in the order
of code points is the form; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow, stage
from telemetry_lake.llm.shingles import mix

# A word is a maximal run of these, after A-Z became a-z.
LETTERS = "[a-zÀ-ÿ]+"
# Fixed value of the task: one run in so many, by its hash, loses a letter.
DROP_EVERY = 199
# Partitions of the dimensions for replacements (two may differ) and insertions (one may).
REPLACE_PARTS, INSERT_PARTS = 6, 4
# Words of a signature before it is refined.
BUCKET = 4_096
# Distinct words a worker holds before it hands its counts on.
HELD_WORDS = 1 << 18
# Kinds of signature rows.
SAME, SHORT, LONG = 0, 1, 2


def run_counts(doc_id, text: str | None, pattern: re.Pattern, drop_every: int | None) -> Counter:
    """The runs of one text with their number, after the seeded slips."""
    runs = Counter(pattern.findall((text or "").encode().lower().decode()))
    if drop_every is None:
        return runs
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    slips = [(run, h) for run in runs if not (h := zlib.crc32(run.encode(), start)) % drop_every]
    moved = [(run[: h % len(run)] + run[h % len(run) + 1 :], runs.pop(run)) for run, h in slips]
    for run, n in moved:
        runs[run] += n
    return runs


def count_words(
    docs: DataFrame, least_length: int = 6, least_n: int = 5, drop_every: int | None = DROP_EVERY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(word, n) of the words of at least so many letters and occurrences, summed in the workers first."""

    def work(batches):
        pattern, held = re.compile(LETTERS), Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.update(run_counts(doc_id, text, pattern, drop_every))
                if len(held) >= HELD_WORDS:
                    yield _count_batch(held, least_length)
                    held = Counter()
        yield _count_batch(held, least_length)

    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    counts = map_arrow(texts, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_n)


def _count_batch(held: Counter, least_length: int) -> pa.RecordBatch:
    kept = [(word, n) for word, n in held.items() if len(word) >= least_length]
    columns = [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def _elements(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, dimension) of every letter: the letter's code and the number of its copy."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    rows = np.repeat(np.arange(len(words), dtype=np.uint64), [len(w) for w in words])
    key = np.sort(rows << np.uint64(32) | codes)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    copy = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)) << np.uint64(32) | copy.astype(np.uint64)


def _cells(rows: np.ndarray, dimensions: np.ndarray, words: int, parts: int, rank: dict[int, int]) -> np.ndarray:
    """Hash of what each word has in each partition.

    The ranked dimensions are dealt to the partitions to and fro, all others by a hash.
    """
    kinds, place = np.unique(dimensions, return_inverse=True)
    spread = (mix(kinds) % np.uint64(parts)).astype(np.int64)
    for k, kind in enumerate(kinds.tolist()):
        if kind in rank:
            turn, step = divmod(rank[kind], parts)
            spread[k] = step if turn % 2 == 0 else parts - 1 - step
    cells = np.zeros((words, parts), dtype=np.uint64)
    np.add.at(cells, (rows, spread[place]), mix(dimensions + np.uint64(1)))
    return cells


def _signatures(cells: np.ndarray, differ: int, salt: np.ndarray) -> np.ndarray:
    """One hash per choice of all partitions but `differ`, in columns."""
    parts = cells.shape[1]
    hashed = mix(cells * (mix(np.arange(1, parts + 1, dtype=np.uint64)) | np.uint64(1)))
    whole = hashed.sum(axis=1, dtype=np.uint64)
    out = [
        mix(whole - hashed[:, list(left_out)].sum(axis=1, dtype=np.uint64) + mix(salt + np.uint64(k << 32)))
        for k, left_out in enumerate(combinations(range(parts), differ))
    ]
    return np.column_stack(out)


def _halves(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first half of `lengths` letters of each word, and of the last others."""
    first = [zlib.crc32(w[: n // 2].encode()) for w, n in zip(words, lengths.tolist(), strict=True)]
    last = [zlib.crc32(w[len(w) - (n - n // 2) :].encode()) for w, n in zip(words, lengths.tolist(), strict=True)]
    return np.array(first, dtype=np.uint32).view(np.int32), np.array(last, dtype=np.uint32).view(np.int32)


def signature_rows(ids: np.ndarray, words: list[str], rank: dict[int, int]) -> list[np.ndarray]:
    """Columns sig, id, kind, head, tail of all signatures of the words."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    rows, dimensions = _elements(words)
    wide = _cells(rows, dimensions, len(words), REPLACE_PARTS, rank)
    narrow = _cells(rows, dimensions, len(words), INSERT_PARTS, rank)
    out = []
    # A long word meets the shorter one under the shorter one's length.
    for kind, cells, differ, length in ((SAME, wide, 2, lengths), (SHORT, narrow, 1, lengths), (LONG, narrow, 1, lengths - 1)):
        salt = length.astype(np.uint64) * np.uint64(2) + np.uint64(kind != SAME)
        sig = _signatures(cells, differ, salt)
        head, tail = _halves(words, length)
        many = sig.shape[1]
        out.append([sig.ravel().view(np.int64), np.repeat(ids, many), np.full(sig.size, kind, dtype=np.int32),
                    np.repeat(head, many), np.repeat(tail, many)])
    return [np.concatenate(column) for column in zip(*out, strict=True)]


def _ranks(words: DataFrame) -> dict[int, int]:
    """Rank by frequency of the first and second copies of each letter: at most two numbers per letter."""

    def work(batches):
        for batch in batches:
            kinds, n = np.unique(_elements(batch.column(1).to_pylist())[1], return_counts=True)
            few = (kinds & np.uint64(0xFFFFFFFF)) < 2
            yield pa.RecordBatch.from_arrays([pa.array(kinds[few].view(np.int64)), pa.array(n[few])], ["kind", "n"])

    counted = map_arrow(words.select("id", "word"), work, "kind long, n long").groupBy("kind").agg(F.sum("n").alias("n"))
    return {row.kind: rank for rank, row in enumerate(counted.orderBy(F.desc("n"), "kind").collect())}


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): ids of words one edit apart, each pair once. `words` is a stored (id, word)."""
    rank = _ranks(words)

    def work(batches):
        for batch in batches:
            columns = signature_rows(batch.column(0).to_numpy(), batch.column(1).to_pylist(), rank)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "id", "kind", "head", "tail"])

    schema = "sig long, id long, kind int, head int, tail int"
    sigs = stage(map_arrow(words.select("id", "word"), work, schema), "spelling-signatures")
    large = stage(sigs.groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET).select("sig"), "spelling-large")
    fits = ((F.col("x.kind") == SAME) & (F.col("y.kind") == SAME) & (F.col("x.id") < F.col("y.id"))) | (
        (F.col("x.kind") == SHORT) & (F.col("y.kind") == LONG)
    )
    small = sigs.join(large, "sig", "left_anti")
    halves = (F.col("x.head") == F.col("y.head")) | (F.col("x.tail") == F.col("y.tail"))
    found = small.alias("x").join(small.alias("y"), (F.col("x.sig") == F.col("y.sig")) & halves & fits)
    ends = (F.struct(F.lit(k).alias("end"), F.col(c).alias("hash")) for k, c in enumerate(("head", "tail")))
    half = F.explode(F.array(*ends))
    split = sigs.join(large, "sig").select("sig", "id", "kind", half.alias("half"))
    refined = split.alias("x").join(
        split.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.half") == F.col("y.half")) & fits
    )
    pair = [F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")]
    candidates = found.select(*pair).union(refined.select(*pair)).distinct()
    spelled = words.select("id", "word")
    both = candidates.join(spelled.select(F.col("id").alias("a"), F.col("word").alias("word_a")), "a").join(
        spelled.select(F.col("id").alias("b"), F.col("word").alias("word_b")), "b"
    )
    return both.where(F.levenshtein("word_a", "word_b", 1) == 1).select("a", "b")


def variants(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of `counts` (word, n).

    The form of a word is its most frequent near word, if that occurs at least `ratio` times
    as often. Forms grow by that factor, so chains are as short as a logarithm and the root
    is reached by doubling steps, whose number the largest n tells.
    """
    words = stage(counts.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = near_pairs(words)
    both = stage(pairs.union(pairs.select("b", "a")).toDF("id", "near"), "spelling-pairs")
    other = words.select(F.col("id").alias("near"), F.col("n").alias("near_n"), F.col("word").alias("near_word"))
    # The smallest of (-n, word) is the most frequent, then the first by UTF-8, which is code-point order.
    best = both.join(other, "near").groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near_word").alias("word"))).alias("best")
    )
    found = words.join(best, "id", "left").withColumn("often", -F.col("best.minus") >= ratio * F.col("n"))
    formed = stage(
        found.select(
            "word", F.when(F.col("often"), F.col("best.word")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("often"), -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    highest = formed.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log2(1 + math.log(highest, ratio))) if highest > 1 else 0
    links = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(steps):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        links = stage(links, "spelling-roots")
    rooted = formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
