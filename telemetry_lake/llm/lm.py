"""Language-model scores: a causal self-attention model over subword ids, and a word unigram beside it.

1. Words (and one end per document) of all training documents are counted in Spark. The
   counts give the unigram score, and through each word's subword ids the exact counts of
   all ids (which of them are output units, and the shares of the others).
2. Every training document is cut into consecutive training windows, so each of its ids is
   a target once. The exact counts of all pairs of neighbours in them, inside words and
   across, are what the model's embeddings start from. In each of ROUNDS every partition trains a copy of the parameters on a
   share of its windows; Spark averages the copies by the number of targets.
3. Texts are scored in windows that overlap: a window's first targets only give context,
   so each token is scored once, after at least OVERLAP tokens of context or its text's
   start. A word's probability is the product over its ids, mixed with the word's share
   of the training words by WORD_SHARE.

The most frequent words are sent to the tasks as arrays of bounded size. Counts of all
other words come from a join on the word's 64-bit hash.

Defined cases: a null or empty text is its end alone; repeated rows are scored row by
row, and count as often in training; without training documents all counts are 0 and the
model stays as it starts; texts and words are scored whole; only id and text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm import attention as A
from telemetry_lake.llm.common import SLICE_BYTES, map_arrow, stage
from telemetry_lake.llm.shingles import as_bytes
from telemetry_lake.llm.tokens import HASHED, Numbers, piece_hashes, worker_encoder

ROUNDS, BATCH, RATE = 3, 64, 0.01
OVERLAP = 8
# Weight of a word's own share against the attention model's probability.
WORD_SHARE = 0.5
# Words whose counts and ids go to every task: 2^20 take some 30 MB.
SENT_WORDS = 1 << 20
# Distinct words that a task counts before it passes them on.
HELD_WORDS = 1 << 19
# Windows that are scored at once.
CHUNK = 128
# Log probabilities are rounded, as the last bits of a product depend on the rows beside.
DECIMALS = 4
# Stands for a document's end among the words, none of which has white space.
END = b"\n"


_WHITE = np.zeros(256, dtype=bool)
_WHITE[list(b" \t\n\x0b\x0c\r")] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


def word_hash(word: bytes) -> int:
    """64-bit hash of a long word."""
    return xxhash.xxh3_64_intdigest(word) or 1


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a text's bytes, none 0; the rare words over HASHED bytes one by one."""
    out = piece_hashes(text, starts, np.minimum(ends, starts + HASHED))
    for k in np.flatnonzero(ends - starts > HASHED):
        out[k] = word_hash(text[starts[k] : ends[k]].tobytes())
    return out


def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of texts, where their words start and end, and the number of words up to each text's end.

    A text's END is a word, too: the line break that is put behind each text.
    """
    text = _LOWER[np.frombuffer(b"".join([part for own in texts for part in (own, END)]), dtype=np.uint8)]
    white = _WHITE[text]
    borders = np.flatnonzero(white[1:] != white[:-1]) + 1
    if len(text) and not white[0]:
        borders = np.concatenate([[0], borders])
    starts, ends = borders[::2], borders[1::2]
    breaks = np.cumsum([len(own) + 1 for own in texts], dtype=np.int64) - 1
    before = np.searchsorted(starts, breaks)
    return text, np.insert(starts, before, breaks), np.insert(ends, before, breaks + 1), before + np.arange(1, len(texts) + 1)


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs that begin at `starts`, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Ids:
    """Subword ids of words; the end is the tokenizer's end token."""

    def __init__(self, tokenizer: str, end_id: int):
        self.encoder, self.end_id = worker_encoder(tokenizer), end_id

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has.

        The tokenizer may drop all of a word of rare white space; id 0 stands for it then.
        """
        ids, starts = self.encoder.encode(words)
        many = np.diff(starts)
        sizes = np.maximum(many, 1)
        firsts = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), dtype=np.int64)
        out[np.arange(len(ids)) + np.repeat(firsts - starts[:-1], many)] = ids
        if END in words:
            out[firsts[[k for k, word in enumerate(words) if word == END]]] = self.end_id
        return out, sizes


def count_words(texts: DataFrame) -> DataFrame:
    """word and n over all texts, ends included; summed in each task before the shuffle."""

    def work(batches):
        seen, words, counts = Numbers(np.zeros(0, dtype=np.uint64)), [], np.zeros(0, dtype=np.int64)
        for batch in batches:
            text, starts, ends, _ = split(as_bytes(batch.column(1)))
            hashes = word_hashes(text, starts, ends)
            numbers = seen.find(hashes)
            missing = np.flatnonzero(numbers < 0)
            new, first = np.unique(hashes[missing], return_index=True)
            words += spans(text, starts[missing[first]], ends[missing[first]])
            seen.add(new)
            numbers[missing] = seen.find(hashes[missing])
            counts = np.pad(counts, (0, len(new)))
            counts += np.bincount(numbers, minlength=len(counts))
            if len(words) > HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], ["word", "n"])
                seen, words, counts = Numbers(new[:0]), [], counts[:0]
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], ["word", "n"])

    return map_arrow(texts, work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def spans(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = text.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def with_ids(counts: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """hash, n and ids of each distinct word."""

    def work(batches):
        encoder = Ids(tokenizer, end_id)
        for words, counts in gathered(batches):
            ids, sizes = encoder.of(words)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), ids.astype(np.int32))
            ends = np.cumsum([len(word) for word in words], dtype=np.int64)
            hashes = word_hashes(np.frombuffer(b"".join(words), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64()), lists], ["hash", "n", "ids"])

    return map_arrow(counts, work, "hash long, n long, ids array<int>", text_column=0)


def gathered(batches):
    """Words and counts of many batches at once, as each call of the encoder has a price, but not more than the bytes of a slice and a batch."""
    words, counts, held = [], [], 0
    for batch in batches:
        new = batch.column(0).to_pylist()
        words += new
        counts += batch.column(1).to_pylist()
        held += sum(map(len, new))
        if held > SLICE_BYTES // 4:
            yield words, counts
            words, counts, held = [], [], 0
    if words:
        yield words, counts


@dataclass
class Vocabulary:
    """Units of the model: the most frequent ids one each, all others share the last."""

    unit: np.ndarray
    # Log share of an id within its unit: 0 but for the shared one.
    share: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        last = A.UNITS - 1
        unit = np.full(len(counts), last, dtype=np.int64)
        unit[np.argsort(-counts, kind="stable")[:last]] = np.arange(last)
        shared = unit == last
        own = counts[shared] + 0.5
        share = np.zeros(len(counts))
        share[shared] = np.log(own / own.sum())
        return cls(unit, share, np.bincount(unit, weights=counts, minlength=A.UNITS))


def neighbours(windows: DataFrame) -> np.ndarray:
    """How often each unit (or START) stands before each other, inside words and across them.

    Counted over the training windows: each target is one place of the training text, and
    the unit before it in its row is the one before it in the text.
    """
    cells = (A.UNITS + 1) * A.UNITS

    def work(batches):
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            column = batch.column(0)
            units, offsets = column.flatten().to_numpy().astype(np.int64), column.offsets.to_numpy()
            inner = np.ones(len(units), dtype=bool)
            inner[offsets[:-1] - offsets[0]] = False
            second = np.flatnonzero(inner)
            total += np.bincount(units[second - 1] * A.UNITS + units[second], minlength=cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    counted = windows.mapInArrow(work, "cell long, n long")
    found = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(cells)
    total[found["cell"].to_numpy()] = found["n"].to_numpy()
    return total.reshape(A.UNITS + 1, A.UNITS)


# Hashes of words, their counts, where the ids of each start (and the last end), and these ids.
Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
NO_WORDS: Table = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64))


class Words:
    """Ids of texts, word by word: those of the words sent from their table, others by the tokenizer."""

    def __init__(self, table: Table, encoder: Ids | None):
        hashes, _, self.starts, self.ids = table
        self.numbers, self.encoder = Numbers(hashes.view(np.uint64)), encoder
        self.sizes = np.diff(self.starts)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word its hash, its number in the table (or -1) and how many ids it has; all ids; words up to each text's end."""
        text, starts, ends, stops = split(texts)
        hashes = word_hashes(text, starts, ends)
        numbers = self.numbers.find(hashes)
        others = np.flatnonzero(numbers < 0)
        first, sizes, ids = self.starts.take(numbers, mode="clip"), np.zeros(len(numbers), dtype=np.int64), self.ids
        if len(self.sizes):
            self.sizes.take(numbers, out=sizes, mode="clip")
        if len(others):
            _, at, of = np.unique(hashes[others], return_index=True, return_inverse=True)
            more, many = self.encoder.of(spans(text, starts[others[at]], ends[others[at]]))
            first[others] = (len(ids) + np.cumsum(many) - many)[of]
            sizes[others] = many[of]
            ids = np.concatenate([ids, more])
        return hashes, numbers, sizes, ids[runs(first, sizes)], stops


def training_windows(texts: DataFrame, vocabulary: Vocabulary, tokenizer: str, end_id: int, sent: Broadcast | None = None) -> DataFrame:
    """`units`: the unit before a window (or START), then its up to WINDOW targets; `round`: when it is learnt from.

    A text's units, its end included, are cut into consecutive windows, so each is a target once.
    A task's windows are dealt to the rounds in turn. `sent` holds a Table of words whose ids are known.
    """
    unit = texts.sparkSession.sparkContext.broadcast(vocabulary.unit.astype(np.int32))

    def work(batches):
        words = Words(NO_WORDS if sent is None else sent.value, Ids(tokenizer, end_id))
        dealt = 0
        for batch in batches:
            _, _, sizes, ids, stops = words.read(as_bytes(batch.column(1)))
            rows, starts = cut(unit.value[ids], np.cumsum(sizes)[stops - 1])
            number = (dealt + np.arange(len(starts) - 1)) % ROUNDS
            dealt += len(number)
            windows = pa.ListArray.from_arrays(starts.astype(np.int32), rows.astype(np.int32))
            yield pa.RecordBatch.from_arrays([windows, pa.array(number.astype(np.int32))], ["units", "round"])

    return map_arrow(texts, work, "units array<int>, round int")


def cut(units: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all windows of texts that end at `stops`, one after another, and where each row starts."""
    sizes = np.diff(stops, prepend=0)
    windows = -(-sizes // A.WINDOW)
    text = np.repeat(np.arange(len(sizes)), windows)
    number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = (stops - sizes)[text] + number * A.WINDOW
    lengths = np.minimum(A.WINDOW, stops[text] - first) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # A row begins one unit before its first target.
    rows = units[runs(first - 1, lengths)] if len(units) else units
    rows[starts[:-1][number == 0]] = A.START
    return rows, starts


def _windows(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of windows of uneven length that lie one after another."""
    lengths = np.diff(offsets)
    rows = np.full((len(lengths), A.WINDOW + 1), A.NONE)
    rows[np.arange(A.WINDOW + 1) < lengths[:, None]] = units
    inputs, targets = rows[:, :-1], rows[:, 1:]
    return np.where(targets == A.NONE, A.START, inputs), targets


def train(windows: DataFrame, parameters: A.Parameters) -> A.Parameters:
    """Parameters after ROUNDS of training copies in all partitions and averaging them.

    A copy leaves its task as a few slices of PART values, weighted by its targets. Tasks that
    take one kind of slice each add them up as they come, so the driver gets each slice once.
    """
    for number in range(ROUNDS):
        sent = windows.sparkSession.sparkContext.broadcast(A.flatten(parameters))

        def work(batches, sent=sent, number=number):
            own = A.Trainer(A.unflatten(sent.value), BATCH)
            adam, seen = A.Adam({"all": own.all}, RATE), 0
            for batch in batches:
                column = batch.column(0)
                inputs, targets = _windows(column.flatten().to_numpy(), column.offsets.to_numpy())
                for k in range(0, len(inputs), BATCH):
                    adam.rate = RATE / (1 + number + seen / 500_000)
                    seen += own.gradients(inputs[k : k + BATCH], targets[k : k + BATCH])
                    adam.step({"all": own.gradient})
            if seen:
                values = np.append(A.flatten(A.Trainer.named(own.p)).astype(np.float64) * seen, seen)
                yield _slices({k // PART: values[k : k + PART] for k in range(0, len(values), PART)})

        def add_up(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for slice_, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    more = value.values.to_numpy()
                    total[slice_] = total[slice_] + more if slice_ in total else more
            yield _slices(total)

        copies = windows.where(F.col("round") == number).select("units").mapInArrow(work, SLICE)
        sums = copies.repartition("slice").mapInArrow(add_up, SLICE).toArrow().sort_by("slice").combine_chunks()
        if sums.num_rows:
            values = sums["values"].chunk(0).flatten().to_numpy()
            parameters = A.unflatten((values[:-1] / values[-1]).astype(np.float32))
    return parameters


SLICE, PART = "slice int, values array<double>", 1024


def _slices(values: dict[int, np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(own) for own in values.values()])]).astype(np.int32)
    flat = pa.array(np.concatenate([np.zeros(0), *values.values()]))
    return pa.RecordBatch.from_arrays([pa.array(list(values), pa.int32()), pa.ListArray.from_arrays(ends, flat)], ["slice", "values"])


def _threshold(vocabulary: DataFrame, most: int) -> int:
    """Least count so that at most `most` words have it; from counts by quarter powers of two."""
    level = F.floor(F.log2("n") * 4).cast("int")
    levels = sorted(((row.level, row.words) for row in vocabulary.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()), reverse=True)
    total, least = 0, None
    for number, words in levels:
        total += words
        if total > most:
            break
        least = number
    return 1 << 62 if least is None else math.ceil(2 ** (least / 4) - 1e-9)


def score(
    docs: DataFrame, training: Column, tokenizer: str, end_id: int, ids: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every whole text.

    `training` says which documents are learnt from; `ids` is the tokenizer's number of
    ids, `end_id` the one for a text's end.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), training.alias("training"))
    learnt = texts.where("training").select("doc_id", "text")
    words = stage(with_ids(count_words(learnt), tokenizer, end_id), "words")
    total = words.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    tokens, distinct = total.tokens or 0, total.words
    counted = words.select(F.explode("ids").alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(ids)
    counts[counted["id"].to_numpy(dtype=int)] = counted["n"].to_numpy(dtype=float)
    vocabulary = Vocabulary.of(counts)
    least = _threshold(words, SENT_WORDS)
    sent = spark.sparkContext.broadcast(_table(words.where(F.col("n") >= least), ids))
    windows = stage(training_windows(learnt, vocabulary, tokenizer, end_id, sent), "windows")
    parameters = train(windows, A.start(vocabulary.counts, neighbours(windows)))
    rows = stage(_scored(texts, sent, tokens, vocabulary, parameters, tokenizer, end_id), "scored")
    open_words = rows.select("row", F.explode(F.arrays_zip("hashes", "spelt")).alias("one")).select("row", "one.hashes", "one.spelt")
    found = open_words.join(words.where(F.col("n") < least).select(F.col("hash").alias("hashes"), "n"), "hashes", "left")
    spelt, own = F.col("spelt") + math.log(1 - WORD_SHARE), F.log(F.col("n") * (WORD_SHARE / max(1, tokens)))
    mixed = F.coalesce(F.greatest(spelt, own) + F.log1p(F.exp(-F.abs(spelt - own))), spelt) / math.log(10)
    sums = found.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count("n").alias("more_known"), F.sum(mixed).alias("more_score")
    )
    base = F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * math.log10(tokens + 0.5 * (distinct + 1))
    columns = [
        "doc_id", "training", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    ]
    # Texts without open words stay out of the join.
    whole = rows.where(F.size("hashes") == 0).withColumns({"more": F.lit(0.0), "more_known": F.lit(0).cast("long"), "more_score": F.lit(0.0)})
    return rows.where(F.size("hashes") > 0).join(sums, "row").select(*columns).union(whole.select(*columns))


def _table(words: DataFrame, ids: int) -> Table:
    """The words for every task."""
    # As Arrow arrays from end to end: a million Python lists would not fit the driver.
    found = words.select("hash", "n", "ids").toArrow().sort_by("hash").combine_chunks()
    lists = found["ids"].chunk(0) if found.num_rows else pa.array([], pa.list_(pa.int32()))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint16 if ids <= 1 << 16 else np.uint32)
    return found["hash"].to_numpy(), found["n"].to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), flat


def _scored(
    texts: DataFrame, sent: Broadcast, tokens: int, vocabulary: Vocabulary, parameters: A.Parameters, tokenizer: str, end_id: int
) -> DataFrame:
    """Per text the sums over the sent words; of each other word its hash and log probability as spelt by the model."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary.unit, vocabulary.share, A.flatten(parameters)))
    kind = texts.schema["doc_id"].dataType.simpleString()
    with_row = texts.select("doc_id", "text", "training", F.monotonically_increasing_id().alias("row"))

    def work(batches):
        unit, share, values = shared.value
        scorer = _Scorer(sent.value, tokens, unit, share, A.unflatten(values), Ids(tokenizer, end_id))
        for batch in batches:
            n, known, logs, scores, ends, *rest = scorer.score(as_bytes(batch.column(1)))
            lists = [pa.ListArray.from_arrays(ends.astype(np.int32), part) for part in rest]
            arrays = [batch.column(3), batch.column(0), batch.column(2), *map(pa.array, (n, known, logs, scores)), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "training", "n_tokens", "n_known", "logs", "score", "hashes", "spelt"])

    schema = f"row long, doc_id {kind}, training boolean, n_tokens long, n_known long, logs double, score double, hashes array<long>, spelt array<double>"
    return map_arrow(with_row, work, schema)


class _Scorer:
    """Scores texts of one task."""

    def __init__(self, table, tokens, unit, share, parameters, encoder):
        self.words, self.unit, self.share = Words(table, encoder), unit, share
        self.reader = A.Reader(parameters)
        # A word that was not sent takes the last place.
        self.logs = np.append(np.log10(table[1] + 0.5), 0.0)
        self.word_shares = np.append(np.log(table[1] * (WORD_SHARE / max(1, tokens))), 0.0)

    def score(self, texts: list[bytes]):
        hashes, numbers, many, ids, stops = self.words.read(texts)
        lengths = np.diff(stops, prepend=0)
        firsts = stops - lengths
        ends = np.cumsum(many)
        spelt = self._spelt(ids, np.concatenate([[0], ends[stops - 1]]))
        spelt = np.add.reduceat(spelt, ends - many)
        is_open = numbers < 0
        mixed = np.logaddexp(self.word_shares[numbers], spelt + math.log(1 - WORD_SHARE)) / math.log(10)
        mixed[is_open] = 0.0
        logs = np.add.reduceat(self.logs[numbers], firsts)
        scores = np.add.reduceat(mixed, firsts)
        known = np.add.reduceat((~is_open).astype(np.int64), firsts)
        open_ends = np.concatenate([[0], np.cumsum(lengths - known)])
        return lengths, known, logs, scores, open_ends, hashes[is_open].view(np.int64), spelt[is_open]

    def _spelt(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log probability of each id in its text; no text is empty, as each has its end."""
        units = self.unit[ids]
        sizes = np.diff(starts)
        step = A.WINDOW - OVERLAP
        windows = np.maximum(1, -(-(sizes - OVERLAP) // step))
        text = np.repeat(np.arange(len(sizes)), windows)
        number = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        first = starts[text] + number * step
        logs = np.zeros(len(ids))
        columns = np.arange(A.WINDOW)
        # The unit before each place, and one more of each, so that windows may reach beyond.
        units = np.concatenate([[A.START], units, np.full(A.WINDOW, A.START)])
        rows = np.lib.stride_tricks.sliding_window_view(units, A.WINDOW + 1)
        lengths = np.minimum(starts[text + 1] - first, A.WINDOW)
        places: list[np.ndarray] = []

        def read_off():
            logs[np.concatenate(places)] = np.round(self.reader.take().astype(np.float64), DECIMALS)
            places.clear()

        # Texts' first windows apart, as all of their targets are wanted.
        for skipped, kind in ((0, np.flatnonzero(number == 0)), (OVERLAP, np.flatnonzero(number))):
            for k in range(0, len(kind), CHUNK):
                part = kind[k : k + CHUNK]
                own = rows[first[part]]
                inputs, targets = own[:, :-1], own[:, 1:]
                if not skipped:
                    inputs[:, 0] = A.START
                wanted = columns < lengths[part, None]
                wanted[:, :skipped] = False
                self.reader.add(inputs, targets, wanted)
                places.append((first[part, None] + columns)[wanted])
                if self.reader.rows >= A.OUTPUT_ROWS:
                    read_off()
        if places:
            read_off()
        return logs + self.share[ids]
