"""Subword ids of whole texts by a public tokenizer, remembering what pieces of text give."""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np

# Distinct pieces a worker remembers; then it keeps those met again, half of that at most.
CACHE_PIECES = 1 << 19
# Name of the module that holds a worker's encoders.
STORE = "telemetry_lake_worker_encoders"
# Pieces encoded by one call, and the control character that parts them there.
CALL_PIECES = 1000
MARK = "\x01"
# How a vocabulary marks the last token of a run of letters, and the pieces that are one such run.
WORD_END = "</w>"
_RUN = re.compile(r"[a-zà-öø-ÿ]+")
# Bytes of a piece that its hash covers; the rare longer pieces are encoded each time.
HASHED = 256

# Kinds of bytes. Pieces end at white space and wherever letters, digits and ASCII
# punctuation meet; OTHER (apostrophes, controls, most of Unicode) is left where it is.
SPACE, LETTER, MARKS, DIGIT, OTHER = range(5)


def _kinds() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[list(b" \t\n\x0b\x0c\r")] = SPACE
    table[list(b"abcdefghijklmnopqrstuvwxyz")] = LETTER
    table[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = MARKS
    table[list(b"0123456789")] = DIGIT
    return table


_KINDS = _kinds()
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
# The lowest 0 to 8 bytes of a number.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def pieces(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-cased UTF-8 bytes."""
    kind = _KINDS[text]
    # Two-byte letters U+00C0 to U+023F, but for the signs U+00D7 and U+00F7, and U+0130,
    # whose lower case ends in a combining mark.
    lead = np.flatnonzero((text[:-1] >= 0xC3) & (text[:-1] <= 0xC8))
    first, second = text[lead], text[lead + 1]
    lead = lead[~((first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC4) & (second == 0xB0))]
    kind[lead] = LETTER
    kind[lead + 1] = LETTER
    before = np.concatenate([[np.uint8(SPACE)], kind[:-1]])
    meets = (kind != before) & (kind != OTHER) & (before != OTHER)
    full = kind != SPACE
    begin = full & (meets | (before == SPACE))
    # A piece ends at the next start or white space, whichever comes first.
    borders = np.flatnonzero(begin | ~full & (before != SPACE))
    own = np.flatnonzero(begin[borders])
    return borders[own], np.append(borders, len(text))[own + 1]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Each number scrambled, no two to the same one."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def piece_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of at most HASHED bytes, none 0: eight bytes after eight, begun with the length."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(text) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    total = _mixed((eight[starts] & _LOWEST[np.minimum(sizes, 8)]) ^ _mixed(sizes.astype(np.uint64)))
    rest, at = np.flatnonzero(sizes > 8), 8
    while len(rest):
        own = eight[starts[rest] + at] & _LOWEST[np.minimum(sizes[rest] - at, 8)]
        total[rest] = _mixed(total[rest] ^ own)
        at += 8
        rest = rest[sizes[rest] > at]
    total[total == 0] = 1
    return total


class Numbers:
    """Numbers of distinct hashes, in the order they were added: a table of slots, looked up by whole arrays."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self._resize(1 << 16)
        self.add(hashes)

    def _resize(self, slots: int) -> None:
        self.keys, self.values = np.zeros(slots, dtype=np.uint64), np.zeros(slots, dtype=np.int32)
        self.shift = np.uint64(64 - (slots.bit_length() - 1))

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Their numbers, -1 for those not there. A hash is in the first slot from its own on that is not another's."""
        slots = self._slots(hashes)
        keys = self.keys[slots]
        out = np.where(keys == hashes, self.values[slots], -1).astype(np.int64)
        left = np.flatnonzero((keys != hashes) & (keys != 0))
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & (len(self.keys) - 1)
            keys, own = self.keys[slots], hashes[left]
            hit = keys == own
            out[left[hit]] = self.values[slots[hit]]
            more = ~hit & (keys != 0)
            left, slots = left[more], slots[more]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Distinct hashes that are not there yet get the next numbers."""
        first, new = len(self.hashes), hashes
        self.hashes = np.concatenate([self.hashes, hashes])
        if 2 * len(self.hashes) > len(self.keys):
            self._resize(1 << (4 * len(self.hashes) - 1).bit_length())
            first, new = 0, self.hashes
        numbers, slots = np.arange(first, first + len(new)), self._slots(new)
        while len(numbers):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = new[free]
            # Of several hashes for one free slot one has got it.
            placed = self.keys[slots] == new
            self.values[slots[placed]] = numbers[placed]
            numbers, new, slots = numbers[~placed], new[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process, with what it has learnt in earlier tasks.

    Functions are shipped by value, so their globals start anew in each task; a module
    that only this process knows keeps the encoders.
    """
    store = sys.modules.setdefault(STORE, types.ModuleType(STORE))
    if path not in store.__dict__:
        store.__dict__[path] = Encoder(path)
    return store.__dict__[path]


class Encoder:
    """Ids of texts, equal to encoding each whole text with add_special_tokens=False.

    For tokenizers that ignore the case of A-Z and white space, and never join letters,
    digits and ASCII punctuation with each other, as `word_bpe_49k`: the text is cut
    there, and only pieces not met before are encoded. Texts with a special token's
    string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        alone = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        apart = self.tokenizer.encode(f"a {MARK} a", add_special_tokens=False).ids
        inner = self.tokenizer.encode("a", add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.mark = alone[0] if len(alone) == 1 and apart == inner + alone + inner else None
        self.known = Numbers(np.zeros(0, dtype=np.uint64))
        self.ids = np.zeros(0, dtype=np.uint32)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)

    def _forget(self) -> None:
        """Forget pieces but for those met in two calls since the last time, half of what is remembered at most."""
        kept = np.flatnonzero(self.uses > 1)
        kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[: CACHE_PIECES // 2]])
        self.ids = self.ids[np.repeat(np.isin(np.arange(len(self.sizes)), kept), self.sizes)]
        self.sizes = self.sizes[kept]
        self.known = Numbers(self.known.hashes[kept])
        self.uses = np.zeros(len(kept), dtype=np.int64)

    def encode_pieces(self, found: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The pieces' order in the result, their ids in one array, and how many each has.

        CALL_PIECES of them go into one text. Where one run of letters follows another,
        the ids that end a word tell them apart; other pieces are parted by MARK, if that
        stands for itself.
        """
        runs = [k for k, piece in enumerate(found) if _RUN.fullmatch(piece)]
        others = sorted(set(range(len(found))).difference(runs))
        ids, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for numbers, parted in ((runs, self._runs), (others, self._marked)):
            for k in range(0, len(numbers), CALL_PIECES):
                own, many = parted([found[n] for n in numbers[k : k + CALL_PIECES]])
                ids.append(own)
                sizes.append(many)
        return runs + others, np.concatenate(ids), np.concatenate(sizes)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _runs(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(" ".join(found))
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(found) or ends[-1] != len(ids) - 1:
            return self._marked(found)
        return ids, np.diff(ends, prepend=-1)

    def _marked(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = f" {MARK} ".join(found)
        if self.mark is None or joined.count(MARK) != len(found) - 1:
            lists = [self._ids(piece) for piece in found]
            return np.concatenate(lists), np.array([len(own) for own in lists], dtype=np.int64)
        ids = self._ids(joined)
        ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _numbers(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number under which each piece's ids are remembered."""
        hashes = piece_hashes(text, starts, ends)
        numbers = self.known.find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            raw, first = text.tobytes(), missing[first]
            cuts = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            order, ids, sizes = self.encode_pieces([raw[a:b].decode() for a, b in cuts])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.uses = np.pad(self.uses, (0, len(new)))
            self.known.add(new[order])
            numbers[missing] = self.known.find(hashes[missing])
        met = np.zeros(len(self.uses), dtype=bool)
        met[numbers] = True
        self.uses += met
        return numbers

    def encode(self, texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids start."""
        raw = [text.encode() if isinstance(text, str) else text or b"" for text in texts]
        odd: set[int] = set()
        joined = b"\n".join(raw)
        if any(special in joined for special in self.special):
            odd = {k for k, text in enumerate(raw) if any(special in text for special in self.special)}
        out, many = self._encode_cut([b"" if k in odd else text for k, text in enumerate(raw)] if odd else raw)
        if odd:
            parts = np.split(out, np.cumsum(many)[:-1])
            for k in odd:
                parts[k] = np.array(self.tokenizer.encode(raw[k].decode(), add_special_tokens=False).ids, dtype=np.uint32)
            out, many = np.concatenate(parts), np.array([len(part) for part in parts])
        return out, np.concatenate([[0], np.cumsum(many)]).astype(np.int64)

    def _encode_cut(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.sizes) > CACHE_PIECES:
            self._forget()
        text = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)]
        starts, ends = pieces(text)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(raw), dtype=np.int64)
        short = ends - starts <= HASHED
        numbers = np.zeros(len(starts), dtype=np.int64)
        if short.any():
            numbers[short] = self._numbers(text, starts[short], ends[short])
        ids, sizes = self.ids, self.sizes
        if not short.all():
            held = text.tobytes()
            cuts = zip(starts[~short], ends[~short], strict=True)
            order, long_ids, long_sizes = self.encode_pieces([held[a:b].decode() for a, b in cuts])
            numbers[np.flatnonzero(~short)[order]] = len(sizes) + np.arange(len(long_sizes))
            ids, sizes = np.concatenate([ids, long_ids]), np.concatenate([sizes, long_sizes])
        many = sizes[numbers]
        stops = np.cumsum(many)
        places = np.arange(stops[-1]) + np.repeat((np.cumsum(sizes) - sizes)[numbers] - stops + many, many)
        # A text's ids are those of the pieces between its start and the next text's.
        begins = np.cumsum([0, *(len(own) + 1 for own in raw)])
        return ids[places], np.diff(np.concatenate([[0], stops])[np.searchsorted(starts, begins)])
