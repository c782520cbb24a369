"""Quality rules as a bitmask ledger: every rule is evaluated once per document.

`ledger` writes the measurements and one long whose bit k says that rule k failed.
Policies are versioned sets of rules applied to the stored bits, so a new policy or an
ablation never reads a text again.

Defined cases: a null or empty text has no words (all measures 0, it fails
`few_words`); repeated rows are judged row by row; an empty table gives no rows; only
the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import WHITE_CLASS

WINDOW = 3
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims"]


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails` is true; its place in RULES is its bit in the ledger."""

    name: str
    fails: str


# Conditions over the measures, in integers, so that no rounding decides.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("exclamations", "100 * n_exclaims > 50 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 40 * n_words"),
]
# A policy is the list of rules that reject; released versions stay as they are.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": [rule.name for rule in RULES],
}
LATEST = "v1"


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    names = [rule.name for rule in RULES]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words that lie in a window whose words occur in another window too.

    Only texts with a repeated window pay for the sort: equal hashes become neighbours,
    their positions are put in order again, and each adds the words that the window
    before it did not cover.
    """
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(rows: Column) -> Column:
        def twice(row: Column, j: Column) -> Column:
            return (row.h == F.get(rows, j - 1).h) | (row.h == F.get(rows, j + 1).h)

        return F.sort_array(F.transform(F.filter(rows, twice), lambda row: row.i))

    def add(state: Column, position: Column) -> Column:
        new = F.least(F.lit(WINDOW), position - state.last)
        return F.struct(position.alias("last"), (state.total + new.cast("long")).alias("total"))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
    # A one-element array stands for a local name: the sorted rows are made once.
    found = F.get(F.transform(F.array(keyed), positions), 0)
    total = F.aggregate(found, start, add, lambda state: state.total)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the words and the measures of every whole text; built-in functions only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, f"{WHITE_CLASS}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_row = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), words.alias("words"), lines.alias("lines"))
    n = F.size("words")
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = by_row.withColumn("hashes", hashes)
    return hashed.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), F.col("hashes")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and `failures`, the bits of the rules that a document fails."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    # As the output of a generator the ledger is evaluated once; a plain projection would be
    # copied into every filter on it.
    entry = F.struct(*MEASURES, failures.cast("long").alias("failures"))
    return measure(docs, id_col, text_col).select("doc_id", F.inline(F.array(entry)))


def apply_policy(book: DataFrame, policy: str = LATEST) -> DataFrame:
    """The ledger with `kept`: none of the policy's rules failed."""
    return book.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0)


def sole_failure(policy: str = LATEST) -> Column:
    """The bit of the one rule of a policy without which a document would be kept; 0 if there is none.

    Sums over rows of equal bits are the policy's ablation: what dropping a rule would let in.
    """
    failed = F.col("failures").bitwiseAND(F.lit(mask(policy)))
    return F.when(F.bit_count(failed) == 1, failed).otherwise(F.lit(0)).cast("long")


def ablations(book: DataFrame, policy: str = LATEST) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    The ledger is first counted by its bits (at most 2^rules groups, combined before the
    shuffle); every rule is then read off those groups.
    """
    wanted = mask(policy)
    groups = book.groupBy(F.col("failures").bitwiseAND(F.lit(wanted)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(RULES[k].name).alias("rule"), F.lit(1 << k).alias("bit"))
                      for k in range(len(RULES)) if wanted >> k & 1))
    per_rule = groups.select("bits", "n", F.explode(rules).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return per_rule.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("only_this"),
    )


def keep_good(docs: DataFrame, policy: str = LATEST) -> DataFrame:
    """The documents that pass a policy, with their own columns only.

    The verdict joins no rows: it is computed beside each document, so repeated ids and
    null ids keep their rows apart.
    """
    inner = F.struct(*(F.col(c) for c in docs.columns)).alias("doc_id")
    judged = apply_policy(ledger(docs.select(inner, F.col("text"))), policy)
    return judged.where("kept").select("doc_id.*")
