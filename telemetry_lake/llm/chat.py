"""Conversations as training texts, assembled by columns, with the mask of what is learnt.

A turn is `### role ###`, a line end, the text, `</turn>` and a line end. In roles and
texts a backslash goes before `###`, `</turn>` and backslashes, so reading back is exact.
The bytes of all turns of a batch are copied at once: segment lengths give cumulative
offsets, offsets give scatter indices, and headers, texts and ends land in one
preallocated buffer. That buffer is the text column of the result, without another copy.

Rows are shuffled by conversation and section, sorted, and passed through batch by batch. A
section is SECTION_TURNS turns by number, so a conversation of any length is dealt over tasks, and shorter
ones stay whole. Rows without a conversation form one, whose sections are its turns, roles and
beginnings of texts. A section longer than PART_BYTES comes out in several parts, so that no task
has to hold one whole. In the order of section and part they are the conversation.

Defined cases: ids are of any type; a null role or text is empty; a null turn comes first; rows
that repeat a turn are all kept, ordered by role and text; turns that are not whole numbers are
ordered, but make no sections; an empty table gives no rows; only the four columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from telemetry_lake.llm.common import map_arrow

# The template's control strings.
MARK, END = "###", "</turn>"
HEAD, NECK, TAIL = f"{MARK} ", f" {MARK}\n", f"{END}\n"
LEARNT_ROLE = "assistant"
# A section's text is cut after the turn that makes it longer than this.
PART_BYTES = 16 << 20
# Turns of a section, and code points of texts that tell the sections of the null conversation.
SECTION_TURNS, LEAD = 1024, 8
# Rows of an open section that a task holds back at most until the section ends.
HELD_ROWS = 8 * SECTION_TURNS


def escape(texts: pa.Array) -> pa.Array:
    """A backslash before backslashes and control strings; null is empty."""
    texts = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    for control in (MARK, END):
        texts = pc.replace_substring(texts, control, "\\" + control)
    return texts


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each value starts."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), starts


def assemble(columns: list[pa.Array | bytes], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' segments one after the other in one buffer, and where each row starts.

    A column is an array of texts or bytes that are the same in every row.
    """
    parts = []
    for column in columns:
        if isinstance(column, bytes):
            parts.append((np.frombuffer(column, np.uint8), np.zeros(rows, np.int64), np.full(rows, len(column))))
        else:
            data, starts = _bytes_of(column)
            parts.append((data, starts[:-1], np.diff(starts)))
    lengths = np.column_stack([size for _, _, size in parts]).reshape(rows, len(parts))
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1, -1]) if rows else 0, dtype=np.uint8)
    for k, (data, starts, size) in enumerate(parts):
        # For every byte of the column: its place within its segment, then source and target.
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(ends[:, k] - size, size) + within] = data[np.repeat(starts, size) + within]
    return out, np.concatenate([[0], ends[:, -1]]) if rows else np.zeros(1, np.int64)


def format_turns(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, starts, and per turn: code points, where its text begins in them, and its text's code points."""
    roles, texts = escape(roles), escape(texts)
    buffer, starts = assemble([HEAD.encode(), roles, NECK.encode(), texts, TAIL.encode()], len(roles))
    begin = np.asarray(pc.utf8_length(roles)).astype(np.int64) + len(HEAD) + len(NECK)
    inner = np.asarray(pc.utf8_length(texts)).astype(np.int64)
    return buffer, starts, begin + inner + len(TAIL), begin, inner


SECTION = "struct<turns: bigint, role: string, lead: string>"


def _section(turns: DataFrame) -> Column:
    """What is formatted in one task; sections of a conversation follow each other in its order."""
    null = F.col("conv_id").isNull()
    whole = isinstance(turns.schema["turn"].dataType, IntegralType)
    turn = F.col("turn").cast("long") if whole else F.lit(0).cast("long")
    # Null and negative turns come first and are in the first section; shifting right is dividing.
    block = F.when(null, turn).otherwise(F.greatest(F.shiftright(turn, SECTION_TURNS.bit_length() - 1), F.lit(0)))
    # Only where turns tell sections may what comes after them in the order do so too.
    split = null & F.lit(whole)
    role = F.when(split, F.col("role")).otherwise(F.lit(""))
    lead = F.when(split, F.substring("text", 1, LEAD)).otherwise(F.lit(""))
    return F.struct(block.alias("turns"), role.alias("role"), lead.alias("lead"))


def format_conversations(turns: DataFrame, learnt: str = LEARNT_ROLE) -> DataFrame:
    """conv_id, section, part, formatted text, and the spans (code points in the part) that count for the loss."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = (
        rows.withColumn("section", _section(rows))
        .repartition("conv_id", "section")
        .sortWithinPartitions("conv_id", "section", "turn", "role", "text")
        .select("conv_id", "text", "role", "section", F.struct(F.col("conv_id").cast("string"), "section").alias("run"))
    )
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, section {SECTION}, part long, formatted string"

    def work(batches):
        held, part = None, 0
        for batch in batches:
            if held is not None:
                same = held.column(4)[-1].as_py() == batch.column(4)[0].as_py()
                if same and held.nbytes <= PART_BYTES and held.num_rows < HELD_ROWS:
                    batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                else:
                    out, number = _parts(held, part, learnt)
                    yield out
                    part = number if same else 0
            starts = _runs(batch)
            if len(starts) > 1:
                yield _parts(batch.slice(0, starts[-1]), part, learnt)[0]
                part = 0
            # The last section may go on in the next batch.
            held = batch.slice(starts[-1])
        if held is not None:
            yield _parts(held, part, learnt)[0]

    return map_arrow(ordered, work, f"{schema}, loss_start array<long>, loss_length array<long>")


def _runs(batch: pa.RecordBatch) -> list[int]:
    """Where the rows of another conversation or section start."""
    keys = batch.column(4).to_pylist()
    return [0] + [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]]


def _parts(rows: pa.RecordBatch, first: int, learnt: str) -> tuple[pa.RecordBatch, int]:
    """The rows' conversations as parts, and the next part's number of the last one; `first` is the first part's."""
    buffer, starts, points, begin, inner = format_turns(rows.column(2), rows.column(1))
    runs, cuts, numbers, number = _runs(rows), [], [], 0
    for k, (at, end) in enumerate(zip(runs, [*runs[1:], rows.num_rows], strict=True)):
        number = 0 if k else first
        while at < end:
            cuts.append(at)
            numbers.append(number)
            number += 1
            at = min(end, int(np.searchsorted(starts, starts[at] + PART_BYTES, side="right")))
    edges = np.array([*cuts, rows.num_rows])
    texts = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(starts[edges].astype(np.int32)), pa.py_buffer(buffer)])
    own = np.flatnonzero(np.asarray(pc.equal(rows.column(2), learnt).cast(pa.int8())))
    before = np.concatenate([[0], np.cumsum(points)])
    spans = pa.array(np.searchsorted(own, edges).astype(np.int32))
    since = before[own] - before[edges[np.searchsorted(edges, own, side="right") - 1]] + begin[own]
    columns = [
        rows.column(0).take(pa.array(cuts)), rows.column(3).take(pa.array(cuts)), pa.array(numbers, pa.int64()), texts,
        pa.ListArray.from_arrays(spans, pa.array(since, pa.int64())), pa.ListArray.from_arrays(spans, pa.array(inner[own], pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "section", "part", "formatted", "loss_start", "loss_length"]), number


# One turn as written by the template: neither its role nor its text holds a bare control string.
# The possessive loops never go back, so a turn of any length is read in one pass.
_INNER = r"((?:[^\\#<]++|\\.|#(?!##)|<(?!/turn>))*+)"
TURN = re.compile(rf"### {_INNER}###\n{_INNER}</turn>\n", re.S)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from the formatted text."""
    at = 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        yield unescape(found[1][:-1]), unescape(found[2])
        at = found.end()


def _read(batches):
    """Of each part: its turns, the bytes that the digests take, and lengths."""
    for batch in batches:
        out = []
        for text, begin, length in zip(*(batch.column(k).to_pylist() for k in (1, 4, 5)), strict=True):
            turns = list(parse(text))
            learnt = "".join(unescape(text[start : start + size]) for start, size in zip(begin, length, strict=True))
            said = "".join(f"{role}\n{own}\n" for role, own in turns)
            out.append((said.encode(), len(turns), len(learnt), learnt.encode(), len(text)))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        names = ["conv_id", "said", "section", "part", "n_turns", "loss_chars", "learnt", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([batch.column(0), columns[0], batch.column(2), batch.column(3), *columns[1:]], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts hold: turns, and the text under the loss mask.

    Parts are parsed where they are. Only a digest is sequential: for that the parts of a
    conversation follow each other in one task, which holds one batch of them.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    parts = map_arrow(
        formatted.select("conv_id", "formatted", "section", "part", "loss_start", "loss_length"), _read,
        f"conv_id {kind}, said binary, section {SECTION}, part long, n_turns long, loss_chars long, learnt binary, formatted_chars long",
    )
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "section", "part")
    rows = ordered.select("conv_id", "said", "n_turns", "loss_chars", "learnt", "formatted_chars", F.col("conv_id").cast("string").alias("run"))

    def work(batches):
        run, total = None, None
        for batch in batches:
            ids, out = batch.column(0), []
            values = zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
            for k, (said, turns, loss, learnt, size, own) in enumerate(values):
                if total is None or own != run:
                    if total is not None:
                        out.append(total)
                    run, total = own, [ids.slice(k, 1), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                total[1] += turns
                total[2].update(said)
                total[3] += loss
                total[4].update(learnt)
                total[5] += size
            yield digests(out, ids.type)
        if total is not None:
            yield digests([total], total[0].type)

    def digests(totals, id_type):
        ids = pa.concat_arrays([t[0] for t in totals]) if totals else pa.array([], id_type)
        columns = [
            ids, pa.array([t[1] for t in totals], pa.int64()), pa.array([t[2].hexdigest() for t in totals], pa.string()),
            pa.array([t[3] for t in totals], pa.int64()), pa.array([t[4].hexdigest() for t in totals], pa.string()),
            pa.array([t[5] for t in totals], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return map_arrow(rows, work, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
