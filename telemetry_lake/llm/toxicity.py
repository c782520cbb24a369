"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding maps look-alike letters and digit substitutions to one letter, drops invisible
characters and turns every other mark into a space, so that `1d10t`, `idiоt` (Cyrillic o)
and `IDIOT!` become one spelling. Lexicon entries are words or word beginnings (stems)
with weights learnt from labelled documents; a hit inside an exception phrase does not
count. The summed weight, alone and divided by the length in words, goes through a
logistic curve.

Defined cases: a null or empty text has no hit and gets the score of a text without
hits; texts are matched whole; repeated rows are scored row by row; with no labelled
rows of both kinds the lexicon is empty and every score is 0; only id, text and label
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow

# Labelled rows used for learning at most; the model is a small lexicon, so more rows
# would only move weights in their later digits. Chosen by a hash of the id.
LEARN_ROWS = 20_000
# Entries of the lexicon at most: it is sent to every task.
LEXICON_SIZE = 5_000
# Stems are word beginnings of so many letters.
STEM_LETTERS = range(4, 10)
# An entry's weight is the log odds of toxic against clean documents, less so many
# standard errors; entries below the least weight are not evidence.
CAUTION, LEAST_WEIGHT = 1.5, 2.5
# A phrase around an entry is an exception if so many clean documents have it and it is
# at most so often toxic.
EXCEPTION_DOCS, EXCEPTION_SHARE = 3, 0.05

# Look-alike letters (Cyrillic, Greek, Latin variants) and what they stand for.
HOMOGLYPHS = {
    "а": "a", "ɑ": "a", "α": "a", "в": "b", "ь": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ё": "e",
    "є": "e", "ε": "e", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ї": "i", "ı": "i", "ι": "i", "ј": "j",
    "к": "k", "κ": "k", "ӏ": "l", "м": "m", "п": "n", "ո": "n", "η": "n", "о": "o", "ο": "o", "օ": "o",
    "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t", "ս": "u", "υ": "u", "ν": "v",
    "ѵ": "v", "ѡ": "w", "ԝ": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ᴢ": "z",
}
# Digits and marks written for letters. `l` and `1` both read as i.
SUBSTITUTES = {
    "0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}
INVISIBLE = "­​‌‍⁠﻿"


class _Fold(dict):
    """Translation table that works out a code point when it is first met."""

    def __missing__(self, code: int) -> str | None:
        char = chr(code)
        if char in INVISIBLE:
            folded = ""
        elif 0xFF01 <= code <= 0xFF5E:  # full-width forms of ASCII
            folded = self[ord(chr(code - 0xFEE0).lower())]
        else:
            char = HOMOGLYPHS.get(char, char)
            folded = SUBSTITUTES.get(char, char if char.isalnum() else " ")
        self[code] = folded
        return folded


_FOLD = _Fold()


def fold_text(text: str | None) -> str:
    """The folded text, with a space before and after."""
    return " " + (text or "").lower().translate(_FOLD) + " "


@dataclass
class Lexicon:
    """Entries (a space, a word beginning, and a space if it is a whole word) with weights."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    # Logistic curve over log(1 + weight), log(1 + 100 * weight / words) and 1.
    curve: tuple[float, float, float] | None = None

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        if len(machine):
            machine.make_automaton()
        return machine


def hits(machine: ahocorasick.Automaton, folded: str) -> list[tuple[int, float]]:
    """Start and weight of each hit: the longest entry at its start, not inside an exception."""
    longest: dict[int, tuple[int, float]] = {}
    excepted = []
    for end, (length, weight) in machine.iter(folded) if len(machine) else ():
        start = end - length + 1
        if weight is None:
            excepted.append((start, end))
        elif length > longest.get(start, (0, 0.0))[0]:
            longest[start] = (length, weight)
    # One sweep: of the exceptions that begin by a hit's start, the one that reaches furthest decides.
    excepted.sort()
    found, reach, following = [], -1, 0
    for start in sorted(longest):
        length, weight = longest[start]
        while following < len(excepted) and excepted[following][0] <= start:
            reach = max(reach, excepted[following][1])
            following += 1
        # The trailing space of a whole word is also the boundary of a phrase; only letters count.
        if start + length - 1 > reach or not folded[start + 1 : start + length].rstrip():
            found.append((start, weight))
    return found


def features(machine: ahocorasick.Automaton, text: str | None) -> tuple[float, int]:
    """Summed weight of the hits, and the length in folded words."""
    folded = fold_text(text)
    return sum(weight for _, weight in hits(machine, folded)), len(folded.split())


def _inputs(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    density = 100 * weight / np.maximum(words, 1)
    return np.column_stack([np.log1p(weight), np.log1p(density), np.ones(len(weight))])


def _fit(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps."""
    x = _inputs(weight, words)
    b = np.zeros(3)
    penalty = np.diag([ridge, ridge, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p) + 1e-6) @ x + penalty, x.T @ (toxic - p) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most `rows` labelled documents: their ids, a bounded list, are broadcast."""
    ids = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def _word_counts(batches):
    """(folded word, toxic) for each distinct word of a document."""
    for batch in batches:
        words, toxic = [], []
        for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            found = set(fold_text(text).split())
            words.extend(found)
            toxic.extend([label] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS, size: int = LEXICON_SIZE, exceptions: Iterable[str] = ()
) -> Lexicon:
    """A lexicon from labelled documents; `exceptions` adds phrases to those found.

    Counting runs in Spark; what comes to the driver is bounded by `size` entries and
    `rows` pairs of numbers.
    """
    given = frozenset(f" {' '.join(fold_text(phrase).split())} " for phrase in exceptions)
    sample = _sample(docs, labels, rows)
    kinds = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    bad, good = kinds.get(1, 0), kinds.get(0, 0)
    if not bad or not good:
        return Lexicon(exceptions=given)
    counts = map_arrow(sample, _word_counts, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    whole = F.concat(F.lit(" "), "word", F.lit(" "))
    stems = (F.when(F.length("word") >= k, F.concat(F.lit(" "), F.substring("word", 1, k))) for k in STEM_LETTERS)
    entries = counts.select(F.explode(F.array_compact(F.array(whole, *stems))).alias("entry"), "bad", "good")
    totals = entries.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    strong = totals.withColumn("weight", odds - CAUTION * error).where(F.col("weight") >= LEAST_WEIGHT)
    best = strong.orderBy(F.desc(F.col("weight") * F.log1p("bad")), "entry").limit(size).collect()
    weights: dict[str, float] = {}
    for row in sorted(best, key=lambda row: (len(row.entry), row.entry)):
        shorter = max((weights.get(row.entry[:k], 0.0) for k in range(2, len(row.entry))), default=0.0)
        if row.weight > shorter + 0.5:  # a longer entry must say more than its beginning
            weights[row.entry] = row.weight
    lexicon = Lexicon(weights, given | _exceptions(sample, weights))
    return _with_curve(sample, lexicon)


def _exceptions(sample: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    """Pairs of words around a hit that clean documents use and toxic ones hardly."""
    lexicon = Lexicon(weights)

    def pairs(batches):
        machine = lexicon.automaton()
        for batch in batches:
            found, toxic = [], []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                folded, own = fold_text(text), set()
                for start, _ in hits(machine, folded):
                    after = folded[start : start + 200].split()[:2]
                    before = folded[max(0, start - 100) : start].split()[-1:]
                    own.add(f" {' '.join(before + after[:1])} ")
                    own.add(f" {' '.join(after)} ")
                own = {phrase for phrase in own if phrase.count(" ") == 3}
                found.extend(own)
                toxic.extend([label] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(toxic, pa.int32())], ["phrase", "toxic"])

    counted = map_arrow(sample, pairs, "phrase string, toxic int").groupBy("phrase").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")
    )
    harmless = counted.where(
        (F.col("n") - F.col("bad") >= EXCEPTION_DOCS) & (F.col("bad") <= EXCEPTION_SHARE * F.col("n"))
    )
    return frozenset(row.phrase for row in harmless.orderBy(F.desc("n"), "phrase").limit(LEXICON_SIZE).collect())


def _with_curve(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    def numbers(batches):
        machine = lexicon.automaton()
        for batch in batches:
            found = [features(machine, text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64()), batch.column(2)],
                ["weight", "words", "toxic"],
            )

    rows = map_arrow(sample, numbers, "weight double, words long, toxic int").collect()
    rows = sorted(tuple(row) for row in rows)  # sums in one order, whatever the order of the tasks
    weight, words, toxic = (np.array(column, dtype=float) for column in zip(*rows, strict=True))
    lexicon.curve = tuple(_fit(weight, words, toxic))
    return lexicon


def _scores(found: list[tuple[float, int]], curve) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, weight and words of some texts; without a curve every score is 0."""
    weight = np.array([w for w, _ in found], dtype=float)
    words = np.array([n for _, n in found], dtype=np.int64)
    if curve is None:
        return np.zeros(len(found)), weight, words
    return 1 / (1 + np.exp(-np.clip(_inputs(weight, words) @ np.array(curve), -30, 30))), weight, words


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted, weight, n_words and n_hits of every whole text."""
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType

    def work(batches):
        machine = lexicon.automaton()
        for batch in batches:
            value, weight, words = _scores([features(machine, text) for text in batch.column(1).to_pylist()], lexicon.curve)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32)), pa.array(weight), pa.array(words)],
                ["doc_id", "score", "predicted", "weight", "n_folded_words"],
            )

    schema = f"doc_id {kind.simpleString()}, score double, predicted int, weight double, n_folded_words long"
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), work, schema)


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents not predicted toxic, with their own columns.

    Whole rows pass through Python, each text once, so that no join by id is needed and
    repeated or null ids keep their own verdicts.
    """
    place = docs.columns.index("text")

    def work(batches):
        machine = lexicon.automaton()
        for batch in batches:
            toxic = _scores([features(machine, text.as_py()) for text in batch.column(place)], lexicon.curve)[0] >= 0.5
            yield batch.filter(pa.array(~toxic))

    return map_arrow(docs, work, docs.schema, place)
