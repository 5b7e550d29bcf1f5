"""Words, shingles and their 64-bit fingerprints, vectorised over Arrow batches.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z are lower-cased
and nothing else is.  ``\\x20`` and 0x09-0x0D never occur inside a multi-byte
UTF-8 character, so bytes can be cut without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20

U64 = np.uint64
_SEED = np.random.default_rng(20_240_607)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: Numbers that tell all bytes apart, and those in which A-Z count as a-z.
EXACT_BYTE = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (the one of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Another hash of 64-bit values for every ``salt``."""
    return mix(x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base))
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = [_powers(_BASE, 1 << 16), _powers(_UNBASE, 1 << 16)]


def _power(which: int, n: int) -> np.ndarray:
    """The first ``n`` powers; kept up to the size of a run."""
    if n > len(_POWERS[which]):
        base = (_BASE, _UNBASE)[which]
        if n > 4 * RUN_BYTES:
            return _powers(base, n)
        _POWERS[which] = _powers(base, n)
    return _POWERS[which][:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the n + 1 offsets into them; null counts as empty."""
    if column.null_count:
        empty = pa.scalar("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"", column.type)
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def runs(at: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``most`` bytes."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the number of its first word (n + 1)."""
    space = _SPACE[data]
    edge = np.empty(len(data) + 1, bool)
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    edge[0], edge[-1] = ~space[0], ~space[-1]
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    # a text's end also ends a word
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    joined = np.unique(inner[~space[inner - 1] & ~space[inner]]) if len(inner) else inner
    marks = np.flatnonzero(edge)
    if len(joined):
        marks = np.sort(np.concatenate([marks, joined, joined]))
    starts, ends = marks[::2], marks[1::2]
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of every word, from one running sum over the bytes; ``table`` has a number per byte."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(table[data] * _power(0, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(1, len(data))[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` successive words in order, and each text's first shingle (n + 1).

    A text of fewer words, but at least one, has its whole sequence as one shingle.
    """
    counts = np.diff(first)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(each)])
    if len(words) == 0:
        return np.zeros(0, np.uint64), at
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    whole = np.zeros(len(words), np.uint64)
    for k in range(size):
        whole = whole * U64(0xD1342543DE82EF95) + padded[k : k + len(words)]
    inside = np.repeat(first[:-1] - at[:-1], each) + np.arange(at[-1])
    out = whole[inside]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = 0
        for w in words[first[i] : first[i + 1]].tolist():
            value = (value * 0xD1342543DE82EF95 + w) % (1 << 64)
        out[at[i]] = U64((value + int(counts[i]) * 0xA0761D6478BD642F) % (1 << 64))
    return mix(out), at


def shingles(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows ``i:j``: every shingle's hash in order, and the texts' bounds in it."""
    data, at = raw(column)
    for i, j in runs(at):
        part, bounds = data[at[i] : at[j]], at[i : j + 1] - at[i]
        starts, ends, first = word_spans(part, bounds)
        found, where = shingle_hashes(word_hashes(part, starts, ends), first, size)
        yield i, j, found, where


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text's distinct values, sorted, and their bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(sizes)])
