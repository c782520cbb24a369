"""Sharding, spelling variants and source divergence, against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telemetry_lake.llm import divergence, sharding, spelling
from telemetry_lake.llm.queries import QUERIES

from .conftest import ALL_IDS, ROWS, SF_DIR, ids_of

here = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not there")

# --- sharding ---


def one_by_one(sizes, capacity):
    """Best fit by looking through all bins for each item."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [b for b in bins if b[0] >= size]
        if size > capacity or not fitting:
            bins.append([max(capacity, size) - size, size])
        else:
            best = min(fitting, key=lambda b: b[0])
            best[0] -= size
            best[1] += size
    return sorted(load for _, load in bins)


def loads(runs, packed):
    out, sizes = Counter(), iter(size for size, n in runs for _ in range(n))
    for groups, shard in packed:
        for _ in range(groups):
            out[shard] += next(sizes)
    assert next(sizes, None) is None
    return out


def runs_of(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=80), st.integers(1, 120))
def test_best_fit_is_that_of_one_by_one(sizes, capacity):
    packed = loads(runs_of(sizes), sharding.best_fit(runs_of(sizes), capacity))
    assert sorted(packed.values()) == one_by_one(sizes, capacity)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=120), st.integers(1, 9))
def test_even_fit_uses_no_more_shards_and_spreads(sizes, shards):
    packed = loads(runs_of(sizes), sharding.even_fit(runs_of(sizes), shards))
    assert set(packed) <= set(range(shards))
    assert max(packed.values()) < sum(sizes) / shards + 2 * max(sizes)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 300_000), max_size=60), st.integers(0, 300_000))
def test_room_tree(members, asked):
    tree = sharding.RoomTree(300_000)
    for value in members:
        tree.add(value)
    assert tree.ceiling(asked) == min((v for v in members if v >= asked), default=None)
    for value in sorted(members)[::2]:
        tree.remove(value)
    left = sorted(members)[1::2]
    assert tree.ceiling(asked) == min((v for v in left if v >= asked), default=None)


def check_shards(rows, texts_by_row, shards):
    """Rows (doc_id, text, shard, slot): all there, equal texts together, slots gapless."""
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(texts_by_row, key=repr)
    where, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        where[r.text or ""].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(found) == 1 for found in where.values())
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert set(slots) <= set(range(shards))


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("root", "shard").withColumnRenamed("band", "pos")
    sharded = sharding.shard(docs, 3)
    assert sorted(sharded.columns) == sorted([*docs.columns, "slot"])
    rows = sharded.collect()
    check_shards(rows, ROWS, 3)
    assert {r.pos for r in rows} == {2}
    assert sharding.shard(no_docs, 4).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(no_docs)


def test_a_group_beyond_its_share_is_alone(spark):
    rng = random.Random(5)
    texts = ["copy " * 30] * 3000 + ["x" * rng.randint(1, 300) + str(i) for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    rows = sharding.shard(docs, 5).collect()
    check_shards(rows, list(enumerate(texts)), 5)
    size = Counter()
    for r in rows:
        size[r.shard] += len(r.text) + 1
    alone = next(r.shard for r in rows if r.text == texts[0])
    assert {r.text for r in rows if r.shard == alone} == {texts[0]}
    others = [n for s, n in size.items() if s != alone]
    assert len(others) == 4 and max(others) - min(others) < 0.01 * min(others)


def test_fixed_capacity(spark, tmp_path):
    rng = random.Random(2)
    texts = ["y" * rng.randint(0, 400) for _ in range(800)] + ["z" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sharded = sharding.shard(docs, capacity=2048)
    groups = [n * (len(t) + 1) for t, n in Counter(texts).items()]
    size = Counter()
    for r in sharded.collect():
        size[r.shard] += len(r.text) + 1
    assert sorted(size.values()) == one_by_one(groups, 2048)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard, r.slot) for r in read.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in sharded.collect())


@here
def test_sharding_query(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = QUERIES["op12_sharding"](spark, SF_DIR).collect()
    assert len(rows) == documents.count()
    size, where = Counter(), defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        size[r.shard] += r["size"]
        where[raw].add(r.shard)
    assert set(size) == set(range(8)) and all(len(s) == 1 for s in where.values())
    assert max(size.values()) - min(size.values()) <= 0.02 * min(size.values())


# --- spelling ---


def brute_counts(rows, drop_every):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(n, ratio=5):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(found, key=lambda v: (-n[v], v)) for w, found in near.items() if found}
    form = {w: v for w, v in best.items() if n[v] >= ratio * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def test_words_with_slips(spark, odd_docs, no_docs):
    for every in (None, 3):
        expected = {w: n for w, n in brute_counts(ROWS, every).items() if len(w) >= 2 and n >= 2}
        found = spelling.count_words(odd_docs, 2, 2, every).collect()
        assert {r.word: r.n for r in found} == expected
    assert spelling.count_words(no_docs).collect() == []
    assert spelling.variants(spelling.count_words(no_docs)).collect() == []


def random_words(rng, many, letters, shortest, longest):
    words = set()
    while len(words) < many:
        word = "".join(rng.choices(letters, k=rng.randint(shortest, longest)))
        words.add(word)
        k = rng.randrange(len(word))
        words.add(word[:k] + rng.choice(letters) + word[k + rng.randint(0, 1) :])
    return sorted(words)


@pytest.mark.parametrize("bucket", [spelling.BUCKET, 3])
def test_variants_are_those_of_brute_force(spark, monkeypatch, bucket):
    """Also where nearly all signatures are refined."""
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    rng = random.Random(11)
    words = random_words(rng, 250, "abc", 1, 8) + random_words(rng, 250, "eärstÿ", 6, 12) + ["q" * 300, "q" * 299]
    n = {w: rng.choice([5, 6, 25, 30, 150, 800, 4000]) for w in words}
    found = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(4))
    assert {tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_variants(n)


@settings(max_examples=200, deadline=None)
@given(st.text("abcdé", min_size=1, max_size=9), st.integers(0, 8), st.sampled_from("abcdéz"), st.booleans())
def test_near_words_share_a_signature(word, at, letter, replaced):
    at %= len(word)
    other = word[:at] + letter + word[at + replaced :]
    if not one_edit(word, other):
        return
    columns = spelling.signature_rows(np.array([0, 1]), [word, other], {})
    rows = set(zip(*(c.tolist() for c in columns), strict=True))
    kinds = (spelling.SHORT, spelling.LONG) if len(other) > len(word) else (spelling.SAME, spelling.SAME)
    # Columns of a row: signature, id, kind, head, tail.
    assert any(
        x[0] == y[0] and x[1] < y[1] and (x[2], y[2]) == kinds and (x[3] == y[3] or x[4] == y[4]) for x in rows for y in rows
    )


@here
def test_spelling_query(spark, documents):
    n = {w: c for w, c in brute_counts([(r.doc_id, r.text) for r in documents.collect()], 199).items() if len(w) >= 6 and c >= 5}
    found = QUERIES["op13_spelling_variants"](spark, SF_DIR).collect()
    assert {r.word: r.n for r in found} == n and len(found) == len(n)
    near = {r.word: r.n_near for r in found}
    for word in sorted(n)[::37]:
        assert near[word] == sum(abs(len(v) - len(word)) < 2 and one_edit(word, v) for v in n)


# --- divergence ---


def brute_audit(rows, least_docs, top):
    """rows: (lang, source, text); the contract, term by term."""
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, langs = defaultdict(Counter), defaultdict(list)
    docs = defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = pattern.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        if source not in langs[lang]:
            langs[lang].append(source)
    out = set()
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            own = [(p[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", own)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items if part == "pair" else items[:top], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("cells, lot", [(divergence.BLOCK_CELLS, divergence.BLOCK_ROWS), (20, 3), (1, 1)])
def test_audit_is_that_of_brute_force(spark, monkeypatch, cells, lot):
    """Also in many small blocks and lots."""
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", lot)
    rng = random.Random(3)
    words = ["Alpha", "beta", "ünï", "中文", "ΔELTA", "x", "yy", "zeta", "OMEGA", "rare"]
    rows = []
    for _ in range(300):
        lang, source = rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "c", "d", "é", "f", "g", None])
        rows.append((lang, source, " ".join(rng.choices(words, range(10, 0, -1), k=rng.randint(0, 12)))))
    rows += [("en", "silent", None), ("en", "silent", ""), ("xx", "only", "lonely words"), ("yy", "one", ""), ("yy", "two", " ")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    found = divergence.audit(docs, 20, 4).select(*COLUMNS).collect()
    expected = brute_audit(rows, 20, 4)
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_audit_of_odd_rows(spark, odd_docs):
    from pyspark.sql import functions as F

    docs = odd_docs.withColumns({"lang": F.lit("l"), "source": F.col("doc_id").cast("string"), "term": F.lit(1), "group": F.lit(2)})
    rows = [("l", None if i is None else str(i), t) for i, t in ROWS]
    assert {tuple(r) for r in divergence.audit(docs, 2).select(*COLUMNS).collect()} == brute_audit(rows, 2, 50)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_ids_stay(odd_docs):
    assert ids_of(sharding.shard(odd_docs, 2)) == ALL_IDS
