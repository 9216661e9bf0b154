"""Words, hashes and line statistics of UTF-8 texts as NumPy arrays.

A text is handled as its bytes. White space is 0x20 and 0x09-0x0D; none of these bytes occurs
inside a multi-byte character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)

#: Bytes of words split by white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of lower-case alphanumeric words; every byte of a character beyond ASCII is one.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def byte_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """Each text of an Arrow column as a byte array without copying; null as an empty one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    valid = column.is_valid().to_pylist()
    for i, there in enumerate(valid):
        yield data[offsets[i] : offsets[i + 1]] if there else data[:0]


def lower(text: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _LOWER[text]


def spans(text: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of bytes that ``kind`` marks."""
    mark = np.zeros(len(text) + 2, dtype=np.int8)
    mark[1:-1] = kind[text]
    edge = np.diff(mark)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_FACTOR, _BLOCK)
_INV = _powers(_INVERSE, _BLOCK)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash factor and of its inverse."""
    if n <= _BLOCK:
        return _POW[:n], _INV[:n]
    return _powers(_FACTOR, n), _powers(_INVERSE, n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def word_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes alone.

    Prefix sums of a polynomial give every word's sum at once; blocks bound the memory of long
    texts, and a word longer than a block is hashed in pieces.
    """
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        first = int(start[i])
        j = int(np.searchsorted(end, first + _BLOCK, side="right"))
        if j <= i:
            total = 0
            for at in range(first, int(end[i]), _BLOCK):
                part = text[at : min(at + _BLOCK, int(end[i]))].astype(np.uint64) + np.uint64(1)
                total = (total * 31 + int(np.sum(part * _POW[: len(part)], dtype=np.uint64))) % (1 << 64)
            out[i] = total
            i += 1
            continue
        part = text[first : int(end[j - 1])].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * _POW[: len(part)], out=sums[1:])
        s, e = start[i:j] - first, end[i:j] - first
        out[i:j] = (sums[e] - sums[s]) * _INV[s]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return words[:0]
    out = words[:n].copy()
    for k in range(1, size):
        out = out * np.uint64(_FACTOR) + words[k : k + n]
    return mix(out)


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``size`` that begins at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0
