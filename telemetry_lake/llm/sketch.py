"""Fast similarity sketching: every coordinate is filled, in time linear in the set.

In each of the first t rounds every element goes to a random one of t bins with a random
value; in the next t rounds all elements go to one bin each, so that at the latest then
every bin is full. A bin keeps its smallest (round, value). Rounds stop for a set when
its bins are full, for most sets after one or two. Two sets agree in a coordinate with
the probability of their Jaccard similarity, and the share of agreeing coordinates
concentrates as that of t independent minima.
"""

from __future__ import annotations

import numpy as np

from telemetry_lake.llm.shingles import STEP, mix

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(elements: np.ndarray, starts: np.ndarray, t: int) -> np.ndarray:
    """One row of t values per set; a row of an empty set is all EMPTY."""
    sets = len(starts) - 1
    bins = np.full(sets * t, EMPTY, dtype=np.uint64)
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(sets), sizes)
    open_sets = sizes > 0
    for number in range(2 * t):
        active = open_sets[owner]
        if not active.any():
            break
        if not active.all():
            elements, owner = elements[active], owner[active]
        hashed = mix(elements ^ mix(np.array([number + 1], dtype=np.uint64) * np.uint64(STEP)))
        place = (hashed >> np.uint64(40)) % np.uint64(t) if number < t else np.uint64(number - t)
        value = (np.uint64(number) << np.uint64(40)) | (hashed & np.uint64((1 << 40) - 1))
        np.minimum.at(bins, owner * t + place.astype(np.int64), value)
        open_sets &= (bins.reshape(sets, t) == EMPTY).any(axis=1)
    return bins.reshape(sets, t)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of `rows` coordinates; the band's number is part of it."""
    sets, t = sketches.shape
    key = np.broadcast_to(np.arange(t // rows, dtype=np.uint64), (sets, t // rows)).copy()
    banded = sketches[:, : t // rows * rows].reshape(sets, t // rows, rows)
    for k in range(rows):
        key = mix(key * np.uint64(STEP) + banded[:, :, k])
    return key
