"""Toxicity, quality rules, near duplicates, decontamination and language-model scores."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemetry_lake.llm import attention, bloom, decontaminate, lm, neardup, quality, shingles, sketch, toxicity
from telemetry_lake.llm.components import components

from .conftest import ALL_IDS, ROWS, ids_of

# --- toxicity ---


def lexicon(**weights):
    return toxicity.Lexicon({f" {toxicity.fold_text(k).strip()} ": v for k, v in weights.items()}, curve=(1.0, 1.0, -3.0))


def test_folding():
    plain = toxicity.fold_text("idiot")
    for spelling in ("1d10t", "IDIOT", "idi\u043et", "ｉｄｉｏｔ", "id\u200biot", "ldlot"):
        assert toxicity.fold_text(spelling) == plain


def naive_hits(entries, exceptions, folded):
    """Every entry at every place: the longest counts, unless its letters lie inside an exception."""
    inside = [(k, k + len(e) - 1) for e in exceptions for k in range(len(folded)) if folded.startswith(e, k)]
    out = []
    for start in range(len(folded)):
        here = [e for e in entries if folded.startswith(e, start)]
        if here:
            length = len(max(here, key=len))
            letters = folded[start + 1 : start + length].rstrip()
            if not letters or not any(a <= start and start + length - 1 <= b for a, b in inside):
                out.append((start, entries[max(here, key=len)]))
    return out


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.text("ab", min_size=1, max_size=4), st.booleans(), max_size=6),
    st.sets(st.text("ab ", min_size=1, max_size=7), max_size=4), st.text("ab ", max_size=40),
)
def test_hits_are_those_of_a_naive_search(words, phrases, text):
    entries = {" " + w + " " * whole: float(k + 1) for k, (w, whole) in enumerate(words.items())}
    exceptions = frozenset(f" {' '.join(p.split())} " for p in phrases if p.strip())
    found = toxicity.Lexicon(entries, exceptions)
    folded = toxicity.fold_text(text)
    assert sorted(toxicity.hits(found.automaton(), folded)) == naive_hits(entries, exceptions, folded)


def test_a_long_text_full_of_hits_and_exceptions():
    """Ten megabytes in seconds, where comparing each hit with each exception took hours."""
    import time

    words = lexicon(idiot=3.0)
    words.exceptions = frozenset({f" {toxicity.fold_text('idiot board').strip()} "})
    begun = time.perf_counter()
    assert toxicity.features(words.automaton(), "the idiot board and idiot " * 400_000)[0] == 3.0 * 400_000
    assert time.perf_counter() - begun < 60


def test_hits_and_exceptions():
    words = lexicon(idiot=3.0)
    assert toxicity.features(words.automaton(), "You 1D1OT!")[0] == 3.0
    assert toxicity.features(words.automaton(), "idiotic")[0] == 0
    words.exceptions = frozenset({f" {toxicity.fold_text('idiot board').strip()} "})
    assert toxicity.features(words.automaton(), "the idiot board")[0] == 0
    assert toxicity.features(words.automaton(), "the idiot board of an idiot")[0] == 3.0
    assert toxicity.features(toxicity.Lexicon().automaton(), "x") == (0, 1)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    scored = toxicity.score(odd_docs, lexicon(dog=4.0))
    assert ids_of(scored) == ALL_IDS
    by_id = {row.doc_id: row for row in scored.collect()}
    assert by_id[2].score == by_id[3].score == by_id[4].score < 0.5
    assert by_id[1].predicted == 1
    assert toxicity.score(no_docs, lexicon(dog=4.0)).count() == 0
    kept = toxicity.drop_toxic(odd_docs, lexicon(dog=4.0))
    assert kept.columns == odd_docs.columns
    assert ids_of(kept) == [i for i in ALL_IDS if i != 1]


def test_learning_without_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.learn(odd_docs, none).weights == {}
    assert all(row.score == 0 for row in toxicity.score(odd_docs, toxicity.learn(odd_docs, none)).collect())


def test_learning_exceptions(spark):
    """A word that is harmless in one phrase: the phrase is found."""
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = f"filler{i} you scum here" if toxic else f"filler{i} pond scum grows" if i % 4 == 1 and i < 40 else f"filler{i} fine words"
        rows.append((i, text))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = {row.doc_id: row.predicted for row in toxicity.score(docs, learnt).collect()}
    assert all(scored[i] == int(i % 4 == 0) for i in scored)


# --- quality rules ---


def brute_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab#| \n\t\x0b\x1cé𝔘", max_size=60), min_size=1, max_size=20))
def test_measures_match_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for row in quality.ledger(docs).collect():
        assert tuple(row[n] for n in names) == brute_measures(texts[row.doc_id])


def test_ledger_and_ablations(spark, odd_docs, no_docs):
    book = quality.ledger(odd_docs)
    assert ids_of(book) == ALL_IDS
    assert quality.ledger(no_docs).count() == 0
    judged = quality.apply_policy(book)
    few = 1 << [rule.name for rule in quality.RULES].index("few_words")
    for row in judged.collect():
        assert bool(row.failures & few) == (row.n_words < 50)
        assert row.kept == (row.failures & quality.mask("v1") == 0)
    rows = {row.rule: row for row in quality.ablations(book).collect()}
    assert rows["few_words"].failed == judged.where("n_words < 50").count()
    # The rows' own bits sum up to the ablation, for every policy.
    for policy, names in quality.POLICIES.items():
        alone = book.select(quality.sole_failure(policy).alias("bit")).where("bit <> 0").groupBy("bit").count()
        found = {quality.RULES[row.bit.bit_length() - 1].name: row["count"] for row in alone.collect()}
        assert found == {row.rule: row.only_this for row in quality.ablations(book, policy).collect() if row.only_this}
        assert set(found) <= set(names)
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert ids_of(kept) == [5]


# --- near duplicates ---


def brute_classes(texts, size, percent=80):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for text in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(upper)) if w]
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def near_copies(seed, count):
    """Families of copies with more and more words replaced, so that chains and limits occur."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(count):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 8, 30])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            if rng.random() < 0.2:
                texts.append(" ".join(copy).upper())
            if rng.random() < 0.3:
                base = copy
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size", [4, 5])
def test_classes_match_brute_force(spark, size):
    texts = near_copies(size, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes, roots = brute_classes(texts, size)
    for row in neardup.near_duplicates(docs, size).collect():
        assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], roots[row.doc_id])
        assert row.kept == (row.doc_id == row.component_id)
    kept = {row.doc_id for row in neardup.keep_one(docs, size).collect()}
    assert kept == {i for i, root in enumerate(roots) if i == root}


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs, 4).collect()
    assert sorted((row.doc_id for row in rows), key=lambda x: (x is not None, x)) == ALL_IDS
    assert all(row.component_id == row.doc_id for row in rows)
    assert neardup.near_duplicates(no_docs, 4).count() == 0
    kept = neardup.keep_one(odd_docs, 4)
    assert kept.columns == odd_docs.columns
    assert ids_of(kept) == [i for k, i in enumerate(ALL_IDS) if k == 0 or i != 6 or ALL_IDS[k - 1] != 6]


def test_rows_without_an_id(spark):
    """They follow an id with the same text and do not stand for others; the pipeline keeps one of each text that no id has."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long + " x"), (None, long), (None, long), (None, long + " y"), (4, long), (5, long + " z"), (None, "apart from all others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs, 4).collect())
    expected = [(3, 3, True), (4, 3, False), (5, 3, False), *[(None, 3, False)] * 2, *[(None, None, True)] * 2]
    assert found == Counter(expected)
    assert sorted(str(r.doc_id) for r in neardup.keep_one(docs, 4).collect()) == ["3", "None", "None"]
    again = spark.createDataFrame([(None, "b"), (None, "a"), (None, "b"), (None, None), (None, "")], docs.schema)
    assert sorted(str(r.text) for r in neardup.keep_one(again, 4).collect()) in (["", "a", "b"], ["None", "a", "b"])


def test_rows_decide_which_copy_stays(spark):
    """Another text under the id of a copy stays; of two near copies under one id, one stays."""
    first, second = (" ".join(f"{stem}{i}" for i in range(60)) for stem in ("w", "v"))
    rows = [(3, first), (7, first + " x"), (7, "a text of its own"), (8, second), (8, second + " y"), (9, second.upper()), (9, second)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(row.doc_id, row.text) for row in neardup.keep_one(docs, 4).collect()]
    assert (3, first) in kept and (7, "a text of its own") in kept
    assert len(kept) == 3 and sorted(i for i, _ in kept) == [3, 7, 8]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for size in (1, 2, 40, 900):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        own = [rng.integers(0, 1 << 63, size // 4, dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([shared, extra])) for extra in own]
        rows = sketch.sketch(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 96)
        assert (rows != sketch.EMPTY).all()
        similarity = size / (size + 2 * (size // 4))
        assert abs((rows[0] == rows[1]).mean() - similarity) < 0.2
    alone = sketch.sketch(np.zeros(0, np.uint64), np.array([0, 0]), 96)
    assert (alone == sketch.EMPTY).all()


def test_shingles_of_short_texts():
    cache = shingles.WordHashes()
    sets, starts = shingles.shingle_sets([b"", b" a ", b"a b", b"A  B", b"b a", b"a b c d", b"a b c d e"], 4, cache)
    assert np.diff(starts).tolist() == [0, 1, 1, 1, 1, 1, 2]
    assert sets[1] == sets[2] != sets[3]


def test_components(spark):
    links = [(b"a", b"b"), (b"b", b"c"), (b"d", b"c"), (b"x", b"y"), (b"z", b"z"), (b"b", b"a")]
    found = components(spark.createDataFrame(links, "a binary, b binary"))
    assert {(bytes(r.node), bytes(r.root)) for r in found.collect()} == {
        (b"a", b"a"), (b"b", b"a"), (b"c", b"a"), (b"d", b"a"), (b"x", b"x"), (b"y", b"x")
    }
    chain = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(300)]
    assert {bytes(r.root) for r in components(spark.createDataFrame(chain, "a binary, b binary")).collect()} == {b"0000"}


def test_bloom_filter(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    hashes = np.array([row.key for row in keys.collect()])
    others = np.array([row.key for row in spark.range(5000, 25000).select(F.xxhash64("id").alias("key")).collect()])
    bits = bloom.build(keys, "key")
    assert bloom.might_contain(bits, hashes).all()
    assert bloom.might_contain(bits, others).mean() < 0.02
    full = bloom.build(keys, "key", max_bytes=320)  # far too small: lets more through, loses nothing
    assert bloom.might_contain(full, hashes).all()
    assert not bloom.might_contain(bloom.build(keys.limit(0), "key"), hashes).any()


# --- benchmark decontamination ---


def edit_distance_inside(item, text):
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        if rng.random() < 0.34:
            out[at] = rng.choice("xyz ")
        elif rng.random() < 0.5:
            out.insert(at, rng.choice("xyz"))
        else:
            del out[at]
    return "".join(out)


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "of", "on", "ering", "tion", "and", "estly", "wh", "ands", "in"]
    items = [" ".join(rng.choices(words, k=rng.choice([3, 9, 20, 40]))) for _ in range(12)]
    texts = []
    for _ in range(40):
        parts = [" ".join(rng.choices(words, k=rng.randrange(0, 80)))]
        if rng.random() < 0.7:
            item = rng.choice(items)
            parts += [edited(rng, item, rng.randrange(0, 2 + len(item) // 7)).upper(), " ".join(rng.choices(words, k=30))]
        texts.append("  \n".join(parts))
    index = decontaminate.Index.of(list(enumerate(items)))
    found = {(row[0], row[1]): row for row in decontaminate.matches(index, texts)}
    for t, text in enumerate(texts):
        own = decontaminate.normal(text)
        for i, item in enumerate(items):
            if i not in index.ids:
                continue
            edits = int(index.edits[index.ids.index(i)])
            best = edit_distance_inside(decontaminate.normal(item), own)
            assert ((t, i) in found) == (best <= edits)
            if best <= edits:
                _, _, cost, start, length = found[t, i]
                assert cost == best
                assert edit_distance_inside(decontaminate.normal(item), own[start : start + length]) == best


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "The quick  brown fox jumps OVER the lazy dog"), (2, None), (3, ""), (4, "ab"), (5, "nowhere to be found in any text")],
        "item_id long, text string",
    )
    rows = decontaminate.contaminated(odd_docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.edits, r.start) for r in rows] == [(1, 1, 0, 0)]
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(odd_docs, bench, chars=40).collect()) == [(1, 1)]
    clean = decontaminate.drop_contaminated(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert ids_of(clean) == [i for i in ALL_IDS if i != 1]
    assert ids_of(decontaminate.drop_contaminated(odd_docs, bench.union(bench), chars=20)) == [i for i in ALL_IDS if i != 1]
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert ids_of(decontaminate.drop_contaminated(odd_docs, bench.limit(0))) == ALL_IDS


# --- language-model scores ---

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def lm_scores(docs, training):
    return lm.score(docs, training, TOKENIZER, 49_407, 49_408).collect()


@pytest.mark.parametrize("sent", [1 << 20, 300, 0])
def test_base_scores_match_brute_force(spark, documents, monkeypatch, sent):
    """Whichever words go to the tasks: also the model's score is the same."""
    monkeypatch.setattr(lm, "SENT_WORDS", sent)
    texts = {row.doc_id: row.text for row in documents.collect()}
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(upper)) if w] + ["\n"] for i, t in texts.items()}
    counts = Counter(w for i, own in words.items() if i % 3 for w in own)
    total = sum(counts.values())
    rows = lm_scores(documents, F.col("doc_id") % 3 != 0)
    assert len(rows) == len(texts)
    for row in rows:
        own = words[row.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
    if sent < 1 << 20:
        monkeypatch.setattr(lm, "SENT_WORDS", 1 << 20)
        whole = {row.doc_id: row.score for row in lm_scores(documents, F.col("doc_id") % 3 != 0)}
        assert all(row.score == pytest.approx(whole[row.doc_id], rel=1e-4) for row in rows)


def test_lm_odd_rows(spark, odd_docs, no_docs):
    rows = lm_scores(odd_docs, F.lit(True))
    assert sorted((row.doc_id for row in rows), key=lambda x: (x is not None, x)) == ALL_IDS
    assert all(math.isfinite(row.score) and row.score < 0 for row in rows)
    empty = [row for row in rows if row.doc_id in (2, 3, 4)]
    assert {row.n_tokens for row in empty} == {1} and len({row.score for row in empty}) == 1
    assert lm_scores(no_docs, F.lit(True)) == []
    untrained = lm_scores(odd_docs, F.lit(False))
    assert {row.train_tokens for row in untrained} == {0} and {row.n_known for row in untrained} == {0}
    assert len(untrained) == len(ROWS)


def test_training_covers_all_text(spark):
    """Long and short texts alike: each id of a text, its end included, is a target exactly once."""
    texts = [" ".join(f"wort{i}-{k}" for i in range(many)) for k, many in enumerate((0, 1, 5, 40, 400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    vocabulary = lm.Vocabulary.of(np.arange(49_408.0))
    rows = [row.units for row in lm.training_windows(docs, vocabulary, TOKENIZER, 49_407).collect()]
    expected = []
    for text in texts:
        ids, _ = lm.Ids(TOKENIZER, 49_407).of([*(w.encode() for w in text.split()), lm.END])
        units = [attention.START, *vocabulary.unit[ids].tolist()]
        expected += [units[k : k + attention.WINDOW + 1] for k in range(0, len(units) - 1, attention.WINDOW)]
    assert rows == expected


def test_pairs_across_words_are_counted(spark):
    """Two words of one unit each, always in the same order: the pair across them is counted as it occurs."""
    texts = ["the house " * many for many in (0, 1, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    vocabulary = lm.Vocabulary.of(np.bincount(lm.Ids(TOKENIZER, 49_407).of([b"the", b"house", lm.END])[0], minlength=49_408))
    pairs = lm.neighbours(lm.training_windows(docs, vocabulary, TOKENIZER, 49_407))
    expected = Counter()
    for text in texts:
        ids, _ = lm.Ids(TOKENIZER, 49_407).of([*(w.encode() for w in text.split()), lm.END])
        units = [attention.START, *vocabulary.unit[ids].tolist()]
        expected.update(zip(units, units[1:]))
    found = {(int(a), int(b)): int(pairs[a, b]) for a, b in zip(*np.nonzero(pairs), strict=True)}
    assert found == expected and expected.most_common(1)[0][1] == 31


def one_target(p, inputs, target):
    """Log probability of the target after the last input, place by place, with a softmax over all units."""
    x = [p["embed"][unit] + p["place"][k] for k, unit in enumerate(inputs)]
    q, k, v = np.split(p["qkv"], 3, axis=1)
    own = np.array([(x[-1] @ q) @ (other @ k) / math.sqrt(attention.WIDTH) for other in x])
    weights = np.exp(own - own.max())
    hidden = x[-1] + sum(w * (other @ v) for w, other in zip(weights / weights.sum(), x, strict=True)) @ p["out"]
    by_group = hidden @ p["group"] + p["group_bias"]
    by_unit = np.einsum("w,gwm->gm", hidden, p["unit"]) + p["unit_bias"]
    odds = by_group[:, None] - np.logaddexp.reduce(by_group) + by_unit - np.logaddexp.reduce(by_unit, axis=1)[:, None]
    return odds.ravel()[target]


def test_overlapping_windows_match_scoring_token_by_token(monkeypatch):
    """Each id is scored once, in the first window that gives it OVERLAP ids of context or its text's start."""
    rng = np.random.default_rng(5)
    p = attention.start(rng.integers(0, 50, attention.UNITS).astype(float), rng.integers(0, 3, (attention.UNITS + 1, attention.UNITS)).astype(float))
    p["out"] *= 5
    wide = {name: value.astype(np.float64) for name, value in p.items()}
    vocabulary = lm.Vocabulary.of(rng.integers(0, 90, 3_000).astype(float))
    none = np.zeros(0, dtype=np.int64)
    texts = [rng.integers(0, 3_000, size) for size in (1, 2, 8, 31, 32, 33, 55, 56, 57, 200)]
    expected = []
    for ids in texts:
        units = [attention.START, *vocabulary.unit[ids].tolist()]
        for t, one in enumerate(ids):
            first = 0 if t < attention.WINDOW else (t - lm.OVERLAP) // (attention.WINDOW - lm.OVERLAP) * (attention.WINDOW - lm.OVERLAP)
            expected.append(one_target(wide, units[first : t + 1], units[t + 1]) + vocabulary.share[one])
    for at_once, chunk in ((1 << 15, 256), (40, 3)):
        monkeypatch.setattr(attention, "OUTPUT_ROWS", at_once)
        monkeypatch.setattr(lm, "CHUNK", chunk)
        scorer = lm._Scorer((none, none, np.zeros(1, dtype=np.int64), none), 1, vocabulary.unit, vocabulary.share, p, None)
        got = scorer._spelt(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
        assert got == pytest.approx(np.array(expected), abs=1e-3)


def test_training_batches_and_rounds(spark, documents):
    """Windows are padded after their targets; every window has its round, rounds are of one size."""
    inputs, targets = lm._windows(np.array([5, 6, 7, 8, 9], dtype=np.int32), np.array([0, 3, 5]))
    assert inputs[:, :3].tolist() == [[5, 6, attention.START], [8, attention.START, attention.START]]
    assert targets[:, :3].tolist() == [[6, 7, attention.NONE], [9, attention.NONE, attention.NONE]]
    assert (inputs[:, 3:] == attention.START).all() and (targets[:, 3:] == attention.NONE).all()
    vocabulary = lm.Vocabulary.of(np.arange(49_408.0))
    windows = lm.training_windows(documents.coalesce(1).select("doc_id", "text"), vocabulary, TOKENIZER, 49_407)
    sizes = [row["count"] for row in windows.groupBy("round").count().orderBy("round").collect()]
    assert len(sizes) == lm.ROUNDS and max(sizes) - min(sizes) <= 1


def test_copies_are_averaged_by_targets(spark, monkeypatch):
    """Three partitions, one of them empty, against training the same windows here."""
    rng = np.random.default_rng(2)
    start = attention.start(rng.integers(1, 50, attention.UNITS).astype(float), rng.integers(0, 3, (attention.UNITS + 1, attention.UNITS)).astype(float))
    parts = [[rng.integers(0, attention.UNITS, size).tolist() for size in sizes] for sizes in ((33, 20, 2), (33,) * 5)]
    monkeypatch.setattr(lm, "ROUNDS", 1)
    rows = [(k, units, 0) for k, part in enumerate(parts) for units in part]
    windows = spark.createDataFrame(rows, "part int, units array<int>, round int").repartitionByRange(3, "part").select("units", "round")
    got = attention.flatten(lm.train(windows, start))
    copies, weights = [], []
    for part in parts:
        own = attention.unflatten(attention.flatten(start))
        adam = attention.Adam(own, lm.RATE)
        adam.step(attention.gradients(own, *lm._windows(np.concatenate(part), np.cumsum([0, *map(len, part)]))))
        copies.append(attention.flatten(own))
        weights.append(sum(len(units) - 1 for units in part))
    assert got == pytest.approx(np.average(copies, axis=0, weights=weights), abs=1e-5)


def test_attention_gradients_and_sums():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, attention.UNITS).astype(float)
    pairs = rng.integers(0, 3, (attention.UNITS + 1, attention.UNITS)).astype(float)
    p = {name: value.astype(np.float64) for name, value in attention.start(counts, pairs).items()}
    inputs = rng.integers(0, attention.UNITS, (2, attention.WINDOW))
    targets = rng.integers(0, attention.UNITS, (2, attention.WINDOW))
    targets[1, 20:] = attention.NONE
    wanted = targets != attention.NONE
    got = attention.gradients(p, inputs, targets)
    for name, value in p.items():
        at = np.unravel_index(np.abs(got[name]).argmax(), value.shape)
        losses = []
        for step in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in p.items()}
            moved[name][at] += step
            losses.append(-attention.log_probabilities(moved, inputs, targets, wanted).mean())
        assert got[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-7)
    # All units' probabilities at one place sum to one, and later inputs do not matter there.
    one = np.zeros((attention.UNITS, attention.WINDOW), dtype=bool)
    one[:, 5] = True
    every = np.tile(targets[:1], (attention.UNITS, 1))
    every[:, 5] = np.arange(attention.UNITS)
    logs = attention.log_probabilities(p, np.tile(inputs[:1], (attention.UNITS, 1)), every, one)
    assert np.exp(logs).sum() == pytest.approx(1)
    later = inputs[:1].copy()
    later[:, 6:] = 3
    again = attention.log_probabilities(p, np.tile(later, (attention.UNITS, 1)), every, one)
    assert again == pytest.approx(logs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aBÉ \n\t\x0b\x0c\r\0\u2003", max_size=12), max_size=4), st.integers(1, 400))
def test_words_and_hashes_are_those_of_each_word(texts, many):
    """As bytes.split has them, each text's end behind; equal words, also long ones, have one hash."""
    raw = [(text * many).encode() for text in texts]
    expected = [[*text.lower().split(), lm.END] for text in raw]
    text, starts, ends, stops = lm.split(raw)
    words = [word for own in expected for word in own]
    assert lm.spans(text, starts, ends) == words
    assert stops.tolist() == np.cumsum([len(own) for own in expected]).tolist()
    hashes = lm.word_hashes(text, starts, ends).tolist()
    assert len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes)) and 0 not in hashes


def test_sent_words_are_not_encoded_again():
    """Ids of the table's words come from the table, all others, once a batch, from the tokenizer."""
    encoder = lm.Ids(TOKENIZER, 49_407)
    known = [b"the", b"house", lm.END]
    ids, sizes = encoder.of(known)
    ends = np.cumsum([len(word) for word in known])
    hashes = lm.word_hashes(np.frombuffer(b"".join(known), dtype=np.uint8), ends - [len(word) for word in known], ends).view(np.int64)
    table = (hashes, np.array([5, 4, 3]), np.concatenate([[0], np.cumsum(sizes)]), ids.astype(np.uint16))
    asked = []

    class Asked(lm.Ids):
        def of(self, words):
            asked.append(sorted(words))
            return super().of(words)

    words = lm.Words(table, Asked(TOKENIZER, 49_407))
    _, numbers, sizes, got, stops = words.read([b"The house the", b""])
    assert asked == [] and numbers.tolist() == [0, 1, 0, 2, 2] and stops.tolist() == [4, 5]
    texts = [b"the garden\xe2\x80\x83 house", b"", b"\xe2\x80\x83 garden garden-house the"]
    _, numbers, sizes, got, stops = words.read(texts)
    flat = [word for text in texts for word in [*text.lower().split(), lm.END]]
    expected, many = encoder.of(flat)
    assert got.tolist() == expected.tolist() and sizes.tolist() == many.tolist() and stops.tolist() == [4, 5, 10]
    assert len(asked) == 1 and asked[0] == sorted({word for word in flat if word not in known})


def test_distinct_words_are_encoded_many_at_a_time(monkeypatch):
    """Small batches of words go to the tokenizer together, up to a bound of their bytes."""
    words = [b"w%04d" % k for k in range(1_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(words[k : k + 10], pa.binary()), pa.array(range(k, k + 10))], ["word", "n"]) for k in range(0, 1_000, 10)]
    assert list(lm.gathered(batches)) == [(words, list(range(1_000)))]
    monkeypatch.setattr(lm, "SLICE_BYTES", 4_000)
    sizes = [len(own) for own, _ in lm.gathered(batches)]
    assert sum(sizes) == 1_000 and max(sizes) <= 210


def test_scores_beyond_the_bound():
    """Scores over the bound count as the bound, in attention, groups and units; all stays finite."""
    rng = np.random.default_rng(3)
    p = attention.start(rng.integers(0, 50, attention.UNITS).astype(float), rng.integers(0, 3, (attention.UNITS + 1, attention.UNITS)).astype(float))
    p["qkv"][:, : 2 * attention.WIDTH] *= 300
    p["group_bias"][3], p["unit_bias"][3, 7], p["unit_bias"][5, 9] = 200, 150, -150
    inputs = rng.integers(0, attention.UNITS, (4, attention.WINDOW))
    targets = rng.integers(0, attention.UNITS, (4, attention.WINDOW))
    targets[0, :3] = 3 * 32 + 7, 5 * 32 + 9, 3 * 32
    got = attention.log_probabilities(p, inputs, targets, np.ones(targets.shape, dtype=bool)).reshape(targets.shape)
    wide = {name: value.astype(np.float64) for name, value in p.items()}
    x = wide["embed"][inputs] + wide["place"]
    q, k, v = np.split(x @ wide["qkv"], 3, axis=2)
    scores = q @ k.transpose(0, 2, 1) / math.sqrt(attention.WIDTH)
    assert scores.max() > 2 * attention.BOUND
    weights = np.tril(np.exp(np.minimum(scores, attention.BOUND)))
    # Rows of nothing but very low scores mix no values.
    hidden = x + weights / (weights.sum(axis=2, keepdims=True) + float(attention.LEAST)) @ v @ wide["out"]
    by_group = np.minimum(hidden @ wide["group"] + wide["group_bias"], attention.BOUND)
    by_unit = np.minimum(np.einsum("nkw,gwm->nkgm", hidden, wide["unit"]) + wide["unit_bias"], attention.BOUND)
    logs = (by_group - np.logaddexp.reduce(by_group, axis=2)[..., None])[..., None] + by_unit - np.logaddexp.reduce(by_unit, axis=3)[..., None]
    expected = np.take_along_axis(logs.reshape(4, attention.WINDOW, -1), targets[..., None], axis=2)[..., 0]
    assert got == pytest.approx(expected, rel=1e-3, abs=1e-3)
    assert all(np.isfinite(value).all() for value in attention.gradients(p, inputs, targets).values())


@settings(max_examples=200, deadline=None)
@given(st.text("aB \n\t\0\u2003", max_size=40), st.integers(1, 9))
def test_normal_form_does_not_depend_on_parts(text, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontaminate, "PIECE_CHARS", size)
        assert decontaminate.normal(text) == " ".join(text.replace("\0", " ").lower().split())


def test_long_texts_are_searched_in_pieces(monkeypatch):
    """The same regions whether a text is searched whole or in overlapping pieces, also across their ends."""
    rng = random.Random(4)
    items = [(k, "".join(rng.choices("abcdefgh ", k=rng.randint(30, 90)))) for k in range(12)]
    index = decontaminate.Index.of(items)

    def damaged(text):
        chars = list(text)
        for _ in range(len(chars) // 15):
            chars[rng.randrange(len(chars))] = "z"
        return "".join(chars)

    texts = []
    for _ in range(6):
        parts = ["".join(rng.choices("ijklmnop ", k=rng.randint(0, 150))) + damaged(rng.choice(items)[1]) for _ in range(40)]
        texts.append("".join(parts))
    texts += [None, "", items[0][1], "x" * 9000]
    whole = decontaminate.matches(index, texts)
    monkeypatch.setattr(decontaminate, "PIECE_CHARS", 64)
    assert len(whole) > 40 and decontaminate.matches(index, texts) == whole


def test_a_very_long_text_takes_bounded_memory():
    """Ten megabytes: the working arrays are those of a piece, not of the text."""
    import tracemalloc

    item = "the quick brown fox jumps over the lazy dog and then sleeps in the warm afternoon sun"
    index = decontaminate.Index.of([(1, item)])
    text = "lorem ipsum dolor sit amet consetetur " * 270_000 + item + " tail"
    tracemalloc.start()
    found = decontaminate.matches(index, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [row[:3] for row in found] == [(0, 1, 0)]
    assert peak < 8 * len(text)
