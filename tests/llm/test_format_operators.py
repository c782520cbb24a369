"""Chat formatting, packing, token counts, HTML extraction and URL filters."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemetry_lake.llm import chat, html, packing, tokencount, tokens, urls
from telemetry_lake.llm.queries import pieces
from telemetry_lake.llm.tokens import Encoder

from .conftest import ALL_IDS, ROWS, ids_of

PATH = public_tokenizers.path("word_bpe_49k.json")

# --- chat ---

TURNS = st.lists(st.tuples(st.text(alphabet="a# \n\\</turn>é𝔘", max_size=25), st.text(alphabet="a# \n\\</turn>é𝔘", max_size=40)), min_size=1, max_size=8)


@settings(max_examples=200, deadline=None)
@given(TURNS)
def test_format_reads_back(turns):
    import pyarrow as pa

    roles, texts = zip(*turns, strict=True)
    buffer, starts, points, begin, inner = chat.format_turns(pa.array(roles), pa.array(texts))
    whole = buffer.tobytes().decode()
    assert list(chat.parse(whole)) == turns
    assert len(whole) == points.sum()
    for k, (role, text) in enumerate(turns):
        own = buffer[starts[k] : starts[k + 1]].tobytes().decode()
        assert chat.unescape(own[begin[k] : begin[k] + inner[k]]) == text


def test_conversations(spark, monkeypatch):
    rows = [
        (1, 1, "assistant", "B </turn> \\###"), (1, 0, "user", "A"), (1, 2, "assistant", None), (2, None, None, "x"),
        (2, 0, "assistant", "dup"), (2, 0, "assistant", "dup"), (None, 0, "user", ""), (3, 0, "assistant", "long " * 2000),
        (3, 1, "assistant", "tail"),
    ]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, part string")
    expected = {}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv))
        learnt = "".join(x for *_, r, x in own if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        expected[conv] = (len(own), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    for part in (chat.PART_BYTES, 100):  # in one part, and in several
        monkeypatch.setattr(chat, "PART_BYTES", part)
        formatted = chat.format_conversations(turns)
        assert (formatted.count() > 4) == (part == 100)
        found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
        assert found == expected
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def digests_of(rows):
    """(turns, digest, learnt characters, digest) by conversation of (id, turn, role, text) rows."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv))
        learnt = "".join(x for *_, r, x in own if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        found[conv] = (len(own), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return found


def test_conversations_of_text_ids_and_many_turns(spark, monkeypatch):
    """Any type of id; a long conversation and the null one are dealt in sections, short ones stay whole."""
    monkeypatch.setattr(chat, "SECTION_TURNS", 64)
    rng = random.Random(3)
    rows = [("hot", k - 700, rng.choice(["user", "assistant"]), f"turn é {k} </turn>") for k in range(3000)]
    rows += [(None, rng.randrange(4), rng.choice(["user", "assistant", None]), rng.choice(["", "a", "some text", "some tether"])) for _ in range(2000)]
    rows += [(f"c{k % 20}", k // 20, "assistant", "x" * k) for k in range(60)]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    formatted = chat.format_conversations(turns)
    parts = {row.conv_id: row["count"] for row in formatted.groupBy("conv_id").count().collect()}
    # Turns up to 2299, the negative ones with the first.
    assert parts["hot"] == -(-2300 // 64) and parts[None] > 10 and all(parts[f"c{k}"] == 1 for k in range(20))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert formatted.where("conv_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert found == digests_of(rows)


def test_formatted_text_is_the_buffer():
    """The text column lies where the bytes were scattered."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict(
        {"conv_id": [1, 1, 2], "text": ["a", "b é", "c"], "role": ["user", "assistant", "user"], "section": [0, 0, 0], "run": ["1", "1", "2"]}
    )
    made, assemble = [], chat.assemble
    try:
        chat.assemble = lambda *a: made.append(assemble(*a)) or made[-1]
        parts, number = chat._parts(rows, 5, "assistant")
    finally:
        chat.assemble = assemble
    assert parts.column(3).buffers()[2].address == made[0][0].ctypes.data
    assert parts.column(2).to_pylist() == [5, 0] and number == 1
    text, (start,), (size,) = (parts.column(k)[0].as_py() for k in (3, 4, 5))
    assert text[start : start + size] == "b é"


# --- tokens and packing ---


def test_encoder_equals_the_tokenizer():
    encoder, rng = Encoder(PATH), random.Random(5)
    odd = ["a<|endoftext|>b c", "İstanbul ΑΣ. é x \u0301y", "", None, " \n ", "a\x1cb\x85c", "don't.'s ,'re …, 1\u0301 3.14 a1b2 \x01", "x" * 1000 + "," + "é" * 300, "中文，ok.字", "Ǉ ɏ, ÷.× ÿ"]
    alphabet = "aZé×÷É.,'!12 \t\n\x01\u0301ßΣσς中…<|>½ǅİ\u00a0\u200b_"
    texts = odd + ["".join(rng.choices(alphabet, k=rng.randrange(1, 50))) for _ in range(3000)]
    ids, starts = encoder.encode(texts)
    for k, text in enumerate(texts):
        assert encoder.tokenizer.encode(text or "", add_special_tokens=False).ids == ids[starts[k] : starts[k + 1]].tolist()


def test_full_encoder_keeps_the_pieces_it_meets_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 200)
    encoder, rng = Encoder(PATH), random.Random(6)
    often = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 30))) for _ in range(50)]
    asked, inner = [], encoder.encode_pieces
    monkeypatch.setattr(encoder, "encode_pieces", lambda found: asked.extend(found) or inner(found))
    for _ in range(12):
        texts = [" ".join([*often, *("".join(rng.choices("fghij", k=9)) for _ in range(40))])]
        ids, _ = encoder.encode(texts)
        assert ids.tolist() == encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert sum(piece in set(often) for piece in asked) == len(set(often))
    assert len(encoder.sizes) <= 300


def test_piece_hashes_tell_pieces_apart():
    """Pieces that differ in one place or in their length only, up to 256 bytes."""
    found = {b"a" * n for n in range(1, 257)} | {b"a" * k + b"b" + b"a" * (39 - k) for k in range(40)} | {b"a\0", b"a\0\0"}
    found |= {b"a" * 7 + bytes([x]) + b"a" * 7 + bytes([y]) for x in range(97, 123) for y in range(97, 123)}
    own = sorted(found)
    text, ends = np.frombuffer(b"".join(own), dtype=np.uint8), np.cumsum([len(piece) for piece in own])
    hashes = tokens.piece_hashes(text, ends - [len(piece) for piece in own], ends)
    assert len(set(hashes.tolist())) == len(own) and hashes.all()


def test_numbers_of_hashes_that_share_slots():
    rng = np.random.default_rng(8)
    hashes = np.unique(rng.integers(1, 1 << 40, 50_000, dtype=np.uint64))  # all in the first slots
    hashes[::2] <<= np.uint64(20)
    hashes = rng.permutation(np.unique(hashes))
    numbers = tokens.Numbers(hashes[:0])
    for k in range(0, len(hashes), 3000):
        part = hashes[k : k + 3000][:40]
        assert (numbers.find(part) == -1).all()
        numbers.add(part)
        assert (numbers.find(numbers.hashes) == np.arange(len(numbers.hashes))).all()


def test_names_of_a_piece_equal_a_full_sort():
    rng, distinct = np.random.default_rng(9), packing.Distinct()
    df = rng.integers(0, 6, 400)
    idf = np.log1p((300 - df + 0.5) / (df + 0.5))
    for _ in range(300):
        piece = rng.integers(0, rng.integers(1, 400), rng.integers(0, 200)).astype("<u2")
        terms, counts = np.unique(piece, return_counts=True)
        weight = counts * (packing.K1 + 1) / (counts + packing.K1 * (1 - packing.B + packing.B * len(piece) / 90)) * idf[terms]
        best = [t for _, t in sorted((-w, t) for w, t in zip(weight.tolist(), terms.tolist(), strict=True) if df[t] > 1)][: packing.NAMES]
        found, many = distinct.of(piece)
        assert dict(zip(found.tolist(), many.tolist(), strict=True)) == dict(zip(terms.tolist(), counts.tolist(), strict=True))
        assert packing.strongest(found, many, len(piece), df, idf, 90) == best + [-1] * (packing.NAMES - len(best))


def check_packed(rows, texts, window=4096):
    """Every id in exactly one piece, sequences gapless and full but for powers of two."""
    tokenizer = Encoder(PATH).tokenizer
    sequences, documents = defaultdict(list), defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
        documents[row.doc_id].append(row)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == window or at < window and at & (at - 1) == 0
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for row in sorted(documents[i], key=lambda row: row.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)


def test_packing_is_whole(spark, documents, odd_docs, no_docs):
    check_packed(pieces(documents).collect(), {row.doc_id: row.text for row in documents.collect()})
    rows = pieces(odd_docs).collect()
    check_packed(rows, {})
    assert {r.doc_id for r in rows} == {i for i, _ in ROWS}
    assert sum(r.length for r in rows if r.doc_id == 6) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 6)
    assert pieces(no_docs).count() == 0


def test_packing_puts_neighbours_together(spark):
    """Two topics, mixed in the input: sequences hold mostly one."""
    rng = random.Random(1)
    topics = [[f"{stem}{c}" for c in "abcdefghij"] for stem in ("zebra", "quartz")]
    texts = [" ".join(rng.choices(topics[i % 2], k=150)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    shares = defaultdict(lambda: [0, 0])
    for row in pieces(docs).collect():
        shares[row.sequence_id][row.doc_id % 2] += row.length
    pure = sum(max(s) for s in shares.values()) / sum(map(sum, shares.values()))
    assert pure > 0.8


def test_packing_finds_neighbours_in_other_tasks(spark):
    """Each topic has one document in each task of the input: sequences hold mostly one topic."""
    rng = random.Random(4)
    stems = ("zebra", "quartz", "window", "garden", "copper", "planet", "summer", "violin")
    topics = [[f"{stem}{c}" for c in "abcdefghij"] for stem in stems]
    texts = [" ".join(rng.choices(topics[i % 8], k=150)) for i in range(64)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 8), "doc_id long, text string")
    shares = defaultdict(lambda: [0] * 8)
    for row in packing.pack(docs, PATH, window=1024).collect():
        shares[row.sequence_id][row.doc_id % 8] += row.length
    assert sum(max(s) for s in shares.values()) / sum(map(sum, shares.values())) > 0.8


def test_common_terms_find_copies():
    """A group of copies that makes over half of a shard: its pieces are still neighbours."""
    copies = [np.arange(10, 30, dtype=np.uint32)] * 6
    index = packing.Index(copies + [np.arange(40, 60, dtype=np.uint32)] * 2, most=1.0)
    assert index.neighbours(copies[0], np.arange(8) > 0).tolist() == [1, 2, 3, 4, 5]


def test_bm25_scores_match_brute_force():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint32) for _ in range(25)]
    index = packing.Index(docs)
    unused = rng.random(25) < 0.8
    query = docs[3]
    mean = np.mean([len(d) for d in docs])
    scores = {}
    for i, d in enumerate(docs):
        for term in set(query.tolist()):
            df = sum(term in e for e in docs)
            tf = (d == term).sum()
            if tf and 1 < df <= 12.5:
                idf = np.log1p((25 - df + 0.5) / (df + 0.5))
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    expected = sorted((i for i in scores if unused[i]), key=lambda i: (-round(scores[i], 9), i))
    assert [round(scores[i], 9) for i in index.neighbours(query, unused)] == [round(scores[i], 9) for i in expected]


# --- token counts ---


def brute_count(model, word):
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(best[end - 1][0] + width * model.byte, best[end - 1][1] - width)]
        for begin in range(end):
            if word[begin:end] in model.scores:
                options.append((best[begin][0] + model.scores[word[begin:end]], best[begin][1] - 1))
        best.append(max(options))
    return -best[-1][1]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abcé𝔘", min_size=1, max_size=12), max_size=30))
def test_trie_counts_match_brute_force(words):
    model = tokencount.Unigram(["a", "b", "ab", "abc", "bc", "ca", "caca", "é"])
    ordered = sorted(words)
    assert model.counts(ordered) == [brute_count(model, word) for word in ordered]


def test_trie_makes_each_prefix_once(monkeypatch):
    """One node for each distinct prefix, whatever the order and however often; counts stay."""
    model = tokencount.Unigram(["a", "b", "ab", "abc", "bc", "ca", "caca"])
    rng = random.Random(7)
    words = ["".join(rng.choices("abcx", k=rng.randrange(1, 9))) for _ in range(400)]
    trie = tokencount.Trie(model)
    assert [trie.count(w) for w in words] == [brute_count(model, w) for w in words]
    assert len(trie.best) == len({w[:n] for w in words for n in range(len(w) + 1)})
    monkeypatch.setattr(tokencount, "DEPTH", 3)
    shallow = tokencount.Trie(model)
    assert [shallow.count(w) for w in words] == [brute_count(model, w) for w in words]
    assert len(shallow.best) == len({w[:n] for w in words for n in range(min(3, len(w)) + 1)})
    # A pre-token of a million characters leaves few nodes.
    assert shallow.count("abcx" * 250_000) == 500_000
    assert len(shallow.best) < 100


def test_token_counts(spark, documents, odd_docs, no_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = tokencount.Unigram.of_file(path)
    texts = {row.doc_id: row.text or "" for row in documents.limit(20).collect()}
    for row in tokencount.count_tokens(documents.limit(20), path).collect():
        words = texts[row.doc_id].split()
        assert row.n_words == len(words)
        assert row.n_tokens == sum(brute_count(model, tokencount.WORD_MARK + w) for w in words)
    rows = tokencount.count_tokens(odd_docs, path)
    assert ids_of(rows) == ALL_IDS
    assert {row.n_tokens for row in rows.collect() if row.doc_id in (2, 3, 4)} == {0}
    assert tokencount.count_tokens(no_docs, path).count() == 0


# --- HTML ---

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="x-sidebar"><header>Site name</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
%s<h1>Head &amp; line</h1><p>Some wor<b>ds</b> of the <a href="x">article</a> &lt;here&gt;.<div class="ad">Buy now</div>
<p>A second,&nbsp;longer paragraph<br>with a break.<script>if (a < b) { "<p>no</p>" }</script><form>Name <input></form>
<!-- hidden <p>no</p> --><p>The end.</p>%s
<section id="comments"><p>First! What a very long comment by a reader that is, more words than the article has in all.</p></section>
<aside>Aside</aside><footer>&copy; Foot</footer></body></html>"""
TEXT = "Head & line Some words of the article <here>. A second, longer paragraph with a break. The end."


@pytest.mark.parametrize("tag", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ("", "")])
def test_main_text(tag):
    assert html.extract(PAGE % tag, html.Weights()) == TEXT


def test_broken_pages():
    weights = html.Weights()
    for source in (None, "", "no tags at all here", "<", "<p", "<!-- open", "<script>open", "<a b='c", "</p></p>", "&#0;&bogus; x"):
        assert isinstance(html.extract(source, weights), str)
    assert html.extract("no tags at all here", weights) == "no tags at all here"
    assert html.extract("<p>a<p>b</div></p>c", weights) == "a b c"
    assert html.extract(None, weights) == ""


def test_best_run_matches_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.randrange(-5, 6) for _ in range(rng.randrange(0, 12))]
        best = max([0] + [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)])
        first, last = html.best_run(scores)
        assert sum(scores[first:last]) == best


def test_pages_odd_rows(spark):
    rows = [(1, "u", PAGE % ("<article>", "</article>")), (2, None, None), (3, "u", ""), (None, "v", "<p>words</p>"), (2, None, None)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    learnt = html.learn(pages)
    found = html.main_texts(pages, learnt).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text) for r in found) == [(0, "v", "words"), (1, "u", TEXT), (2, "", ""), (2, "", ""), (3, "u", "")]
    assert html.main_texts(pages.limit(0), html.learn(pages.limit(0))).count() == 0


# Pages whose boilerplate has names that no list knows, around articles that only some pages label.
LEARNT = """<html><body><div class="qx1"><ul><li><a href="/">One two three four five six</a></li></ul></div>
<div class="qx2">Seven words that nobody calls an advert.</div>%s<h1>Head of %d</h1><p>First words of the text.</p><p>More of it.</p>
<div class="qx3"><p>Inside a box of the text.</p></div><p>End.</p>%s<div class="qx4"><p>Owned by somebody since the year dot.</p></div></body></html>"""
LEARNT_TEXT = "Head of %d First words of the text. More of it. Inside a box of the text. End."


def test_learning_tells_unknown_names_apart(spark):
    labelled = [(k, "u", LEARNT % ("<article>", k, "</article>")) for k in range(40)]
    pages = spark.createDataFrame(labelled, "page_id long, url string, html string")
    weights = html.learn(pages)
    for k in range(3):
        # With the label and without it, as an extraction does not look at it.
        assert html.extract(LEARNT % ("<article>", k, "</article>"), weights) == LEARNT_TEXT % k
        assert html.extract(LEARNT % ("", k, ""), weights) == LEARNT_TEXT % k
        assert html.extract(LEARNT % ("", k, ""), html.Weights()) != LEARNT_TEXT % k


def test_scan_cuts_what_no_name_tells_apart(spark, monkeypatch):
    # Links in boxes with names that no labelled page has, at both ends of a page without a label.
    boxes = "".join(f'<div class="zz{k}"><span><a href="/{k}">w{k}</a></span></div>' for k in range(30))
    page = LEARNT.replace("<body>", f"<body>{boxes}").replace("</body>", f"{boxes}</body>") % ("", 1, "")
    pages = spark.createDataFrame([(k, "u", LEARNT % ("<main>", k, "</main>")) for k in range(40)], "page_id long, url string, html string")
    weights = html.learn(pages)
    assert html.extract(page, weights) == LEARNT_TEXT % 1
    monkeypatch.setattr(html, "best_run", lambda scores: (0, len(scores)))
    assert html.extract(page, weights) != LEARNT_TEXT % 1


def test_lists_are_weak_priors(spark):
    # A listed name that holds articles on labelled pages counts.
    page = '<body><div class="social-page">%s<p>Text of the page that is an article.</p>%s</div><div class="other">Something else.</div></body>'
    pages = spark.createDataFrame([(k, "u", page % ("<article>", "</article>")) for k in range(40)], "page_id long, url string, html string")
    assert html.extract(page % ("", ""), html.Weights()) == "Something else."
    assert html.extract(page % ("", ""), html.learn(pages)) == "Text of the page that is an article."


def test_reading_is_linear_in_tags():
    # A hundred thousand tags: open ones, stray ends, names of their own, ends across each other.
    n = 100_000
    for source in ("<div>x" * n, "x</em></section>" * n, "".join(f'<div class="a{k}b">x' for k in range(n)), "<ul><li>x<div></ul>" * n):
        start = time.perf_counter()
        html.extract(source, html.Weights())
        assert time.perf_counter() - start < 20


# --- URLs ---


def test_urls(spark):
    rules = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("block", "net", "/es/")]
    given = [
        ("http://Example.COM/en/1?utm_source=x", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://a.example.com/fr/", "a.example.com", "/fr/", "com/", "allow"),
        ("https://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://x.net/es/a#b://c", "x.net", "/es/a", "net/es/", "block"),
        ("http://x.org?q=/a", "x.org", "", None, "allow"),
        ("ftp://www.listed.org/page/?ref=y&b=2&a=1#top", "www.listed.org", "/page/", None, "block"),
        ("http://listed.org:80/page?a=1&b=2", "listed.org:80", "/page", None, "block"),
        ("http://listed.org/page?a=1", "listed.org", "/page", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, row[0], "x") for k, row in enumerate(given)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("http://listed.org/page?b=2&a=1",), (None,)], "url string").select(urls.canonical(F.col("url")).alias("canonical"))
    for size in (1 << 20, 32):  # a filter too small to tell anything apart gives the same verdicts
        rows = sorted(urls.judge(pages, listed, rules, max_bytes=size).collect())
        assert [(given[r.page_id][0], r.host, r.path, r.rule, r.verdict) for r in rows] == given
    assert urls.judge(pages, listed.limit(0), rules).where("verdict = 'block'").count() == 2
    assert urls.judge(pages.limit(0), listed, rules).count() == 0
