"""Word shingles of texts as sets of 64-bit hashes, many documents at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

# Words whose hashes a worker remembers; then it starts anew.
CACHE_WORDS = 1 << 18
# Finaliser constants of a 64-bit mixer.
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def shingle_sets(texts: list[bytes], size: int, cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in one array, sorted in each text, and where each text's start.

    Words are lower-cased A-Z and split at ASCII white space. Fewer words than `size`
    make one shingle of the whole sequence; no words make none.
    """
    split = [text.lower().split() for text in texts]
    words = np.array([cache[w] for own in split for w in own], dtype=np.uint64)
    multipliers = mix(np.arange(1, size + 2, dtype=np.uint64) * np.uint64(STEP)) | np.uint64(1)
    sets, first = [], 0
    for own in split:
        n = len(own)
        own_words = words[first : first + n]
        first += n
        if n >= size:
            total = np.zeros(n - size + 1, dtype=np.uint64)
            for k in range(size):
                total += own_words[k : n - size + 1 + k] * multipliers[k]
            sets.append(np.unique(mix(total)))
        elif n:
            total = (own_words * multipliers[:n]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(total + multipliers[size:] * np.array([n], dtype=np.uint64)))
        else:
            sets.append(own_words)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=starts[1:])
    return (np.concatenate(sets) if sets else words), starts
