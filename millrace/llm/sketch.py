"""Fast similarity sketching of sets of 64-bit fingerprints.

Every element is thrown into one of ``size`` bins per round, with a fresh hash
for each round, and a bin keeps the least (round, value).  A text stops when
all its bins are filled.  After ``size`` rounds, round ``size + b`` puts every
element into bin ``b``, so that a set of one element also fills all bins.  A
set of n elements needs about ``1 + size * ln(size) / n`` rounds, and every
coordinate agrees between two sets with probability equal to their similarity.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.words import U64, salted

_LOW = U64((1 << 48) - 1)
EMPTY = U64(2**64 - 1)


def sketch(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates per set; sets are ``values[at[i]:at[i+1]]``.

    An empty set's coordinates are all EMPTY.
    """
    n = len(at) - 1
    out = np.full(n * size, EMPTY)
    counts = np.diff(at)
    owner = np.repeat(np.arange(n), counts)
    left = np.flatnonzero(counts > 0)
    for turn in range(2 * size):
        if len(left) == 0:
            break
        if turn:
            keep = np.zeros(n, bool)
            keep[left] = True
            mine = keep[owner]
            owner, values = owner[mine], values[mine]
        hashed = salted(values, turn)
        bins = (hashed >> U64(48)).astype(np.int64) * size >> 16 if turn < size else turn - size
        np.minimum.at(out, owner * size + bins, U64(turn << 48) | (hashed & _LOW))
        left = left[(out.reshape(n, size)[left] == EMPTY).any(axis=1)]
    return out.reshape(n, size)


def bands(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; equal bands have equal keys."""
    n, size = sketches.shape
    count = size // rows
    cut = sketches[:, : count * rows].reshape(n, count, rows)
    key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), (n, count)) * U64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = salted(key ^ cut[:, :, k], k + 1)
    return key
