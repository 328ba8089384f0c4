"""Elias-Fano sequences and the two-level n-gram trie made of them.

A non-decreasing sequence is kept as its low bits, packed, and its high parts in unary, with one
count of ones per 64-bit word to find the n-th one or zero. All lookups are vectorised.

The trie holds the contexts of one shard (sorted), monotone pointers to each context's range of
successors, and the successors. Successors only rise within a context, so each range is shifted
by the last value of the range before it and the whole level is one monotone sequence; a
successor is looked up relative to that base. Probabilities and back-off weights are bytes on a
logarithmic scale. Everything lies in one memory-mapped file that is already unlinked.
"""

from __future__ import annotations

import tempfile

import numpy as np

_U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: [byte, n] -> place of the n-th one
_PLACE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _PLACE[_b, :_POP[_b]] = [i for i in range(8) if _b >> i & 1]


def _pick(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the n-th one (from 0) in each 64-bit word."""
    octets = words[:, None].view(np.uint8)
    ones = np.cumsum(_POP[octets], axis=1, dtype=np.int64)
    octet = (ones <= n[:, None]).sum(axis=1)
    rows = np.arange(len(words))
    before = np.where(octet > 0, ones[rows, octet - 1], 0)
    return 8 * octet + _PLACE[octets[rows, octet], n - before]


class EliasFano:
    """``parts`` are the arrays to store: high words, ones before each word, low words."""

    def __init__(self, n: int, low: int, parts: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.n, self.low, self.parts = n, low, parts
        self.high, self.ones, self.lows = parts
        self.zeros = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Of a sorted array of uint64."""
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low = max(0, (top // max(1, n)).bit_length() - 1)
        at = (values >> _U(low)).astype(np.int64) + np.arange(n)
        # a last zero after the ones of every high part, so each can be found
        size = n + (top >> low) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[at] = 1
        high = np.packbits(bits, bitorder="little").view(_U)
        per_word = _POP[high[:, None].view(np.uint8)].sum(axis=1, dtype=np.int64)
        ones = np.r_[0, np.cumsum(per_word)[:-1]].astype(np.int64)
        lows = np.zeros(n * low // 64 + 2, _U)
        if low:
            part = values & _U((1 << low) - 1)
            bit = np.arange(n, dtype=np.int64) * low
            word, off = bit >> 6, (bit & 63).astype(_U)
            np.bitwise_or.at(lows, word, part << off)
            spill = np.where(off > 0, part >> (_U(63) - np.maximum(off, _U(1)) + _U(1)), _U(0))
            np.bitwise_or.at(lows, word + 1, spill)
        return cls(n, low, (high, ones, lows))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), _U)
        bit = i * self.low
        word, off = bit >> 6, (bit & 63).astype(_U)
        rest = np.where(off > 0, self.lows[word + 1] << (_U(63) - np.maximum(off, _U(1)) + _U(1)), _U(0))
        return ((self.lows[word] >> off) | rest) & _U((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = 64 * word + _pick(self.high[word], i - self.ones[word])
        return ((place - i).astype(_U) << _U(self.low)) | self._low(i)

    def _below(self, part: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``part``."""
        if self.zeros is None:
            self.zeros = 64 * np.arange(len(self.ones)) - self.ones
        nth = np.maximum(part - 1, 0)
        word = np.searchsorted(self.zeros, nth, side="right") - 1
        place = 64 * word + _pick(~self.high[word], nth - self.zeros[word])
        return np.where(part > 0, place - nth, 0)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each ``x``, or -1: the successor of x, if it is x itself."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        top = self.get(np.array([self.n - 1]))[0]
        some = np.flatnonzero(x <= top)
        part = (x[some] >> _U(self.low)).astype(np.int64)
        low = x[some] & _U((1 << self.low) - 1)
        a, b = self._below(part), self._below(part + 1)
        end = b
        todo = np.flatnonzero(a < b)
        while len(todo):
            mid = (a[todo] + b[todo]) >> 1
            less = self._low(mid) < low[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b = b.copy() if b is end else b
            b[todo] = np.where(less, b[todo], mid)
            todo = todo[a[todo] < b[todo]]
        inside = np.flatnonzero(a < end)
        same = inside[self._low(a[inside]) == low[inside]]
        out[some[same]] = a[same]
        return out


class Trie:
    """Contexts, their successors, and the codes of both; opened from one mapped file."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray,
                 backoffs: np.ndarray, probabilities: np.ndarray):
        """``contexts`` sorted, ``sizes`` the length of their ranges in ``successors`` (sorted in
        each range); ``backoffs`` and ``probabilities`` are bytes."""
        ends = np.cumsum(sizes)
        last = successors[ends - 1].astype(_U) + _U(1)
        base = np.r_[_U(0), np.cumsum(last)[:-1]].astype(_U) if len(sizes) else np.empty(0, _U)
        levels = [EliasFano.of(contexts.astype(_U)),
                  EliasFano.of(np.r_[0, ends].astype(_U)),
                  EliasFano.of(successors.astype(_U) + np.repeat(base, sizes))]
        arrays = [p for level in levels for p in level.parts] + [backoffs, probabilities]
        with tempfile.TemporaryFile() as f:  # unlinked: it is gone when the mapping is
            for a in arrays:
                f.write(np.ascontiguousarray(a).tobytes())
            f.flush()
            self.bytes = f.tell()
            raw = np.memmap(f, np.uint8, "r", shape=(self.bytes,)) if self.bytes else np.empty(0, np.uint8)
        views, at = [], 0
        for a in arrays:
            views.append(raw[at:at + a.nbytes].view(a.dtype))
            at += a.nbytes
        self.contexts, self.pointers, self.successors = (
            EliasFano(level.n, level.low, tuple(views[3 * k:3 * k + 3])) for k, level in enumerate(levels))
        self.backoffs, self.probabilities = views[9], views[10]

    def find(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """Position of each context, and of each of its ``sizes`` successors; -1 where absent."""
        at = self.contexts.find(contexts.astype(_U))
        begin = np.zeros(len(at), np.int64)
        known = np.flatnonzero(at >= 0)
        begin[known] = self.pointers.get(at[known]).astype(np.int64)
        base = np.zeros(len(at), _U)
        shifted = np.flatnonzero(begin > 0)
        if len(shifted):
            base[shifted] = self.successors.get(begin[shifted] - 1) + _U(1)
        stop = np.zeros(len(at), np.int64)
        stop[known] = self.pointers.get(at[known] + 1).astype(np.int64)
        found = self.successors.find(successors.astype(_U) + np.repeat(base, sizes))
        inside = (found >= np.repeat(begin, sizes)) & (found < np.repeat(stop, sizes))
        return at, np.where(inside, found, -1)
