"""Elias-Fano sequences: monotone integers as packed low bits and a bit vector
of high bits, with vectorised access and search over mapped memory."""

from __future__ import annotations

import numpy as np

from .bitpack import pack

_U = np.uint64


def _arrays(parts: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(p, _U).tobytes() for p in parts)


class EliasFano:
    """``n`` non-decreasing integers. Stored words: ``n``, low bits ``l``, words
    of the low part, words of the high part, then both parts and the number of
    zeros before each high word."""

    @staticmethod
    def build(values: np.ndarray, universe: int) -> bytes:
        values = np.asarray(values, _U)
        n = len(values)
        l = min(60, max(0, (max(1, int(universe) // max(1, n))).bit_length() - 1))  # shifts by 64 bits don't exist
        low = pack(values & _U((1 << l) - 1), l) if l else np.empty(0, _U)
        low = np.append(low, _U(0))
        high = (values >> _U(l)) + np.arange(n, dtype=_U)
        bits = np.zeros((int(high[-1]) // 64 + 1 if n else 0) * 64 + 64, np.uint8)  # a word of zeros at the end
        bits[high.astype(np.int64)] = 1
        words = np.packbits(bits, bitorder="little").view(_U)
        zeros = 64 - np.bitwise_count(words).astype(np.int64)
        return _arrays([np.array([n, l, len(low), len(words)], _U), low, words, np.cumsum(zeros) - zeros])

    def __init__(self, raw: np.ndarray):
        """``raw``: 64-bit words that begin with a stored sequence."""
        self.n, self.l, a, b = (int(x) for x in raw[:4])
        self.low, self.high = raw[4: 4 + a], raw[4 + a: 4 + a + b]
        self.zeros = raw[4 + a + b: 4 + a + 2 * b]
        self.words = 4 + a + 2 * b

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the ``k``-th (from 0) one, or zero if ``flip``."""
        w = np.searchsorted(before, k, "right") - 1
        left = k - before[w]
        v = ~self.high[w] if flip else self.high[w].copy()
        at = w.astype(np.int64) * 64
        for step in (32, 16, 8, 4, 2, 1):
            c = np.bitwise_count(v & _U((1 << step) - 1)).astype(_U)
            up = left >= c
            left = np.where(up, left - c, left)
            v = np.where(up, v >> _U(step), v)
            at += up * step
        return at

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), _U)
        bit = i.astype(_U) * _U(self.l)
        w, shift = (bit >> _U(6)).astype(np.int64), bit & _U(63)
        v = self.low[w] >> shift
        over = shift + _U(self.l) > 64
        if over.any():
            v[over] |= self.low[w[over] + 1] << (_U(64) - shift[over])
        return v & _U((1 << self.l) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The ``i``-th values."""
        ones = np.arange(len(self.zeros), dtype=_U) * _U(64) - self.zeros
        high = self._select(i.astype(_U), ones, False).astype(_U) - i.astype(_U)
        return (high << _U(self.l)) | self.lows(i)

    def find(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Index of each value between ``lo`` and ``hi``, or -1."""
        out = np.full(len(values), -1, np.int64)
        h = values >> _U(self.l)
        last = int(self.zeros[-1]) + 63  # zeros there are, less one
        ok = h < last
        if not self.n or not ok.any():
            return out
        h, want = h[ok], values[ok] & _U((1 << self.l) - 1)
        end = self._select(h, self.zeros, True) - h.astype(np.int64)
        start = np.zeros(len(h), np.int64)
        some = h > 0
        start[some] = self._select(h[some] - _U(1), self.zeros, True) - (h[some].astype(np.int64) - 1)
        if lo is not None:
            start, end = np.maximum(start, lo[ok]), np.minimum(end, hi[ok])
        stop = end.copy()
        open_ = np.flatnonzero(start < end)
        while len(open_):
            mid = (start[open_] + end[open_]) >> 1
            less = self.lows(mid) < want[open_]
            start[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]
            open_ = open_[start[open_] < end[open_]]
        hit = np.flatnonzero(start < stop)
        hit = hit[self.lows(start[hit]) == want[hit]]
        out[np.flatnonzero(ok)[hit]] = start[hit]
        return out
