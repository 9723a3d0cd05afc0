"""Vectorised text work inside tasks: Arrow string columns are read as one
byte buffer and cut, hashed and grouped with numpy, so that no Python loop
runs per word. Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``.

A word is identified by a 64-bit hash of its bytes: every byte value at every
place of a word has a random number of its own (tabulation), and a word's hash
is the finalised sum of its bytes' numbers. No structure of a word meets
structure of the numbers, as it could with powers of a base; two different
words of one corpus share a hash with probability about
``distinct_words ** 2 / 2 ** 65``. Where one hit decides a result for good, the
bytes are compared (``encode``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_SEED = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[0x21 + i for i in range(94) if not chr(0x21 + i).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit integers."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


# One random number for every byte value at every one of the first places of a word.
_PLACES = 64
# Bytes that are hashed at once, so that they stay in a core's cache.
_RUN_BYTES = 1 << 16


def _number(cell: np.ndarray) -> np.ndarray:
    """The number of a byte value (low 8 bits) at a place (the other bits)."""
    return mix(mix(cell + _U(_SEED)) ^ _U(_SEED))


_TABLE = _number(np.arange(_PLACES << 8, dtype=_U))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the ``len + 1`` offsets of its rows;
    a null row is empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, off, data = col.buffers()
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets from 0)`` for runs of rows whose
    texts have at most ``limit`` bytes together, or a single longer text."""
    data, offsets = text_bytes(col)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for every row (and the end) the
    number of words before it. A row's end ends a word."""
    solid = ~_SPACE[data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = solid[edge]
    ends[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``words``, but each piece takes the white space before it along, so
    that the pieces of a row cover it (white space at its end is a piece), and
    ASCII punctuation after an ASCII letter starts a piece of its own."""
    solid = ~_SPACE[data]
    starts = ~solid
    starts[1:] &= solid[:-1]
    starts[1:] |= _PUNCT[data[1:]] & _LETTER[data[:-1]]
    at = offsets[:-1]
    starts[at[at < len(data)]] = True
    start = np.flatnonzero(starts)
    return start, np.append(start[1:], len(data)), np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ascending spans that don't overlap."""
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _RUN_BYTES, "right")))
        a, b = int(start[i]), int(end[j - 1])
        place = np.arange(b - a, dtype=np.int32 if b - a < 1 << 22 else np.int64)
        place -= np.repeat((start[i:j] - a).astype(place.dtype), np.diff(np.append(start[i:j], b)))
        cell = (place << 8) | data[a:b]
        far = np.flatnonzero(place >= _PLACES)
        beyond = cell[far]
        cell[far] = 0
        run = np.zeros(b - a + 1, _U)
        np.take(_TABLE, cell, out=run[1:])
        run[1:][far] = _number(beyond.astype(_U))
        np.cumsum(run, out=run)
        out[i:j] = run[end[i:j] - a] - run[start[i:j] - a]
        i = j
    return mix(out + (end - start).astype(_U))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of A-Z lower-cased rows, and the words before each row."""
    data = lower(data)
    start, end, before = words(data, offsets)
    return hash_spans(data, start, end), before
