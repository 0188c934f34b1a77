"""Whole-batch text work on the bytes of Arrow string columns, in numpy.

Words, their hashes and n-grams of many texts are found with a few vector
operations, in chunks of about ``CHUNK`` bytes so that memory stays bounded
whatever the batch; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text is a chunk by itself).
CHUNK = 1 << 19
U64 = np.uint64
_AZ = np.arange(256, dtype=np.uint8)
_AZ[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = x ^ (x >> U64(30))  # a copy, worked on in place from here on
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = U64(_BASE)
    return np.multiply.accumulate(out)


_POWERS = _powers(1024)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def lower_az(data: np.ndarray) -> np.ndarray:
    return _AZ[data]


def in_words(data: np.ndarray) -> np.ndarray:
    """Which bytes are not white space."""
    return ~_IS_SPACE[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, row) of each run of non-white-space bytes."""
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    after = np.flatnonzero(~inside)
    ends = np.append(after, len(data))[np.searchsorted(after, starts)]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(ends, offsets[rows + 1])
    return starts, ends - starts, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in a fixed base over
    randomised byte values, with the length, finalised."""
    global _POWERS
    if not len(starts):
        return np.zeros(0, np.uint64)
    if int(lengths.max()) > len(_POWERS):
        _POWERS = _powers(int(lengths.max()) * 2)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    rel = np.arange(total) - np.repeat(first, lengths)
    terms = _BYTE[data[np.repeat(starts, lengths) + rel]] * _POWERS[rel]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def join_hashes(*parts: np.ndarray) -> np.ndarray:
    """One hash for a sequence of hashes, order-sensitive."""
    out = parts[0]
    for p in parts[1:]:
        out = mix(out * U64(0xD6E8FEB86659FD93) + p)
    return out


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
