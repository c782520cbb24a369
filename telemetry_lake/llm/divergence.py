"""Divergence of the sources of a language, by Gustavson's row accumulation.

Every text's terms are counted once, in the workers, into (lang, source, term) rows. A
language keeps the terms of at least LEAST_DOCS of its documents. In a group (lang, source)
a kept term has the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)) with the group's count
of all kept terms N and the V terms kept; the language as a whole has shares by the same law.

The distance of two groups is the sum of |p - q| over all kept terms. A term that neither
has, or one of them, counts with the group's baseline, the share of a count of zero. For a
block of terms each group walks its own terms through the term-major index and adds to a
dense accumulator with one cell per peer what a shared term differs from its two baselines;
what the own terms and the absent ones add follows from sorted shares and counts. So no
pairs of postings are made; a block hands on one number per pair of groups.

Blocks hold about BLOCK_CELLS (group, term) cells, chosen by a hash of the term, and rows go
through them in lots of BLOCK_ROWS groups. Where there are many groups a block is larger, as
many cells as a lot hands on numbers, so that no more is handed on than was read. All arithmetic is in whole numbers: shares in
38-digit decimals, distances in 64 bits.

Defined cases: null text, lang and source count as empty; a group without terms has its
baseline everywhere; a language that keeps no terms has distances of 0 and no term rows; a
language of one source has no pairs; repeated rows count again; an empty table gives no
rows. Only text, lang and source are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow, stage

# A term: letters, after A-Z became a-z. Everything beyond ASCII is a letter.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
# Added to every count.
SMOOTHING = 5
# Characteristic terms told per group.
TOP_TERMS = 50
# Cells (group, term) of a block, and groups that go through it at once.
BLOCK_CELLS, BLOCK_ROWS = 1 << 16, 256
# Cells a worker holds before it hands its counts on.
HELD_CELLS = 1 << 18


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) of every term of every group, summed in the workers first."""

    def work(batches):
        pattern, held, cells = re.compile(TERM), defaultdict(dict), 0
        for batch in batches:
            for group in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                lang, text, source = group
                own = held[lang, source]
                cells -= len(own)
                for term, n in Counter(pattern.findall(text.encode().lower().decode())).items():
                    cell = own.get(term)
                    if cell is None:
                        own[term] = [n, 1]
                    else:
                        cell[0] += n
                        cell[1] += 1
                cells += len(own)
                if cells >= HELD_CELLS:
                    yield _cells_batch(held)
                    held.clear()
                    cells = 0
        yield _cells_batch(held)

    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                          for c, name in ((lang_col, "lang"), (text_col, "text"), (source_col, "source"))))
    counted = map_arrow(texts, work, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _cells_batch(held: dict) -> pa.RecordBatch:
    langs, sources, terms, n, docs = [], [], [], [], []
    for (lang, source), own in held.items():
        langs += [lang] * len(own)
        sources += [source] * len(own)
        terms += own
        n += [cell[0] for cell in own.values()]
        docs += [cell[1] for cell in own.values()]
    columns = [pa.array(c, pa.string()) for c in (langs, sources, terms)] + [pa.array(c, pa.int64()) for c in (n, docs)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _share(count: str, whole: str):
    """1 + floor(10^9 count / whole), exact."""
    return F.expr(f"1 + cast((cast(1000000000 as decimal(38,0)) * ({count})) div ({whole}) as bigint)")


def block_distances(cells: pd.DataFrame, peers: pd.DataFrame, rows: range) -> pd.DataFrame:
    """(a, b, value) for the groups `rows` and all peers after them, over the terms of one block.

    `cells` has group, term and p; `peers` has the baseline of every group, in their order.
    """
    size, base = len(peers), peers["base"].to_numpy()
    term = pd.factorize(cells["term"])[0]
    group, p = cells["group"].to_numpy(), cells["p"].to_numpy()
    terms = int(term.max()) + 1 if len(term) else 0
    by_term = np.argsort(term, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=terms))]) if terms else np.zeros(1, dtype=np.int64)
    by_group = np.argsort(group, kind="stable")
    own_first = np.searchsorted(group[by_group], np.arange(size + 1))
    held = np.diff(own_first)
    index_group, index_p = group[by_term], p[by_term]
    out_a, out_b, out_value = [], [], []
    sorted_p = [np.sort(p[by_group[own_first[g] : own_first[g + 1]]]) for g in range(size)]
    toward = np.array([_away(shares, base[rows.start : rows.stop]) for shares in sorted_p])
    for a in rows:
        later = np.arange(a + 1, size)
        if not len(later):
            continue
        own = by_group[own_first[a] : own_first[a + 1]]
        # Scatter: every term of the group goes through its postings into one cell per peer.
        low, high = first[term[own]], first[term[own] + 1]
        many = high - low
        owner = np.repeat(own, many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        peer, q, mine = index_group[at], index_p[at], p[owner]
        shared = np.bincount(peer, minlength=size)
        change = np.abs(mine - q) - np.abs(mine - base[peer]) - np.abs(q - base[a])
        total = np.zeros(size, dtype=np.int64)
        np.add.at(total, peer, change)
        total += _away(sorted_p[a], base) + toward[:, a - rows.start]
        absent = terms - held[a] - held + shared
        total += absent * np.abs(base[a] - base)
        out_a.append(np.full(len(later), a))
        out_b.append(later)
        out_value.append(total[later])
    columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (out_a, out_b, out_value)]
    return pd.DataFrame(dict(zip(("a", "b", "value"), columns, strict=True)))


def _away(sorted_p: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """Sum of |p - base| over the sorted shares, for each base."""
    upto = np.concatenate([[0], np.cumsum(sorted_p)])
    below = np.searchsorted(sorted_p, bases)
    return bases * below - upto[below] + (upto[-1] - upto[below]) - bases * (len(sorted_p) - below)


def _distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): a and b are the numbers of two groups of the language, a < b."""
    lot = F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot")
    placed = cells.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    placed = placed.select("lang", "block", "group", "term", "p", lot)
    of_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    peers = groups.select("lang", of_block, "lots", "group", "base").select("lang", "block", lot, "group", "base")

    def work(key, cells, peers):
        peers = peers.sort_values("group")
        first = int(key[2]) * BLOCK_ROWS
        found = block_distances(cells, peers, range(first, min(first + BLOCK_ROWS, len(peers))))
        return found.assign(lang=key[0])[["lang", "a", "b", "value"]]

    keys = ("lang", "block", "lot")
    parts = placed.groupBy(*keys).cogroup(peers.groupBy(*keys)).applyInPandas(work, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: every other source of the language with its distance. Part `term`: the
    terms of the group whose share is above the language's, with the difference. Ranks go
    by value, largest first, then by item, for each group and part.
    """
    counts = stage(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = of_lang.where(F.col("docs") >= least_docs).drop("docs")
    kept = stage(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))))
    group_n = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("cells"))
    # One row per kept term of a language.
    terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count("*").alias("kept_terms"), F.sum("n").alias("lang_total")
    )
    groups = names.distinct().join(group_n, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = groups.fillna(0, ["group_n", "cells", "kept_terms", "lang_total"])
    # One row per language, carried by its groups to their cells: these are never dealt by language.
    sizes = groups.groupBy("lang").agg(F.sum("cells").alias("cells"), F.count("*").alias("peers"))
    most = F.greatest(F.lit(BLOCK_CELLS), BLOCK_ROWS * F.col("peers"))
    sizes = sizes.select(
        "lang", F.greatest(F.lit(1), F.ceil(F.col("cells") / most)).cast("int").alias("blocks"),
        F.ceil(F.col("peers") / BLOCK_ROWS).cast("int").alias("lots"),
    )
    groups = groups.drop("cells").join(sizes, "lang")
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("group")
    groups = groups.select("*", number, (F.col("group_n") + SMOOTHING * F.col("kept_terms")).alias("whole"))
    base = F.when(F.col("whole") > 0, _share(f"{SMOOTHING}", "whole")).otherwise(0).alias("base")
    groups = stage(groups.select("*", base), "divergence-groups")

    cells = kept.join(groups, ["lang", "source"])
    shared = [_share(f"n + {SMOOTHING}", "whole").alias("p"),
              _share(f"lang_n + {SMOOTHING}", f"lang_total + {SMOOTHING} * kept_terms").alias("q")]
    cells = stage(cells.select("lang", "source", "group", "term", "blocks", "lots", *shared), "divergence-cells")

    half = _distances(cells, groups)
    pairs = half.union(half.select("lang", "b", "a", "value"))
    named = groups.select("lang", "source", "group")
    pairs = pairs.join(named.withColumnRenamed("group", "a"), ["lang", "a"]).join(
        named.select("lang", F.col("group").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", F.lit("pair").alias("part"), "item", "value"]
    pairs = pairs.select(*columns, F.row_number().over(best_first).alias("rank"))
    own = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    own = own.select("*", F.row_number().over(best_first).alias("rank")).where(F.col("rank") <= top_terms)
    return pairs.unionByName(own)
