"""Texts as runs of bytes, the very long ones in slices that never cut a word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm.words import RUN_BYTES, raw, runs

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes between words: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def spans(data: np.ndarray, at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each text's first word (n + 1); ``gap`` marks bytes between words."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return none, none, np.zeros(len(at), np.int64)
    inside = ~gap[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = at[1:-1]  # a text's end is a word's end as well
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, at)


def slices(column: pa.Array, gap: np.ndarray, carry: int, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, bool]]:
    """``i, j, bytes, bounds, fresh, last`` for runs of rows ``i:j`` of about ``most`` bytes.

    A longer text comes in several slices of the same row, cut between words.
    Each begins with the last ``carry`` words of the one before: what ends at or
    before byte ``fresh`` has been seen already.  ``last`` marks a row's end.
    """
    most = most or RUN_BYTES
    data, at = raw(column)
    for i, j in runs(at, most):
        part, bounds = data[at[i] : at[j]], at[i : j + 1] - at[i]
        if j - i > 1 or len(part) <= 2 * most:
            yield i, j, part, bounds, 0, True
            continue
        start = fresh = 0
        while fresh < len(part) or fresh == 0:
            end = _cut(part, fresh + most, gap)
            piece = part[start:end]
            yield i, j, piece, np.array([0, len(piece)]), fresh - start, end == len(part)
            starts = spans(piece, np.array([0, len(piece)]), gap)[0]
            if end == len(part):
                break
            start, fresh = start + int(starts[-carry]) if 0 < carry <= len(starts) else (start if carry else end), end


def _cut(part: np.ndarray, at: int, gap: np.ndarray, step: int = 1 << 16) -> int:
    """The first place from ``at`` on that lies between words."""
    while at < len(part):
        found = np.flatnonzero(gap[part[at : at + step]])
        if len(found):
            return at + int(found[0])
        at += step
    return len(part)
