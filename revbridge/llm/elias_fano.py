"""Elias-Fano sequences and a two-level trie over them, queried in whole arrays.

A sequence of n increasing numbers below u keeps the low floor(log2(u / n)) bits of each
in one packed run of words and the high parts in unary: 1 bit an element, 0 bit a step.
The k-th element is the place of the k-th one bit; the elements from a value on begin
after the zero bit of its high part.  All of it lies in flat arrays, so that a file of
them is mapped into memory and read as it is.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

U64 = np.uint64


def _place_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) one bit of each word."""
    at, left = np.zeros(len(words), np.int64), k.astype(np.int64)
    rest = words
    for width in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(rest & U64((1 << width) - 1)).astype(np.int64)
        past = left >= ones
        left = left - np.where(past, ones, 0)
        at += np.where(past, width, 0)
        rest = np.where(past, rest >> U64(width), rest)
    return at


class EliasFano:
    """`n` non-decreasing numbers; `arrays` are the flat parts it is read from."""

    def __init__(self, n: int, low_bits: int, arrays: list[np.ndarray]):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.ones = arrays

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(1, n)).bit_length() - 1)
        values = values.astype(U64)
        low = np.zeros(n * low_bits // 64 + 2, U64)
        if n and low_bits:
            bit = np.arange(n, dtype=U64) * U64(low_bits)
            part, word, shift = values & U64((1 << low_bits) - 1), (bit >> U64(6)).astype(np.int64), bit & U64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = (shift + U64(low_bits)) > U64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        place = (values >> U64(low_bits)) + np.arange(n, dtype=U64)
        high = np.zeros((int(place[-1]) if n else 0) // 64 + 2, U64)
        np.bitwise_or.at(high, (place >> U64(6)).astype(np.int64), U64(1) << (place & U64(63)))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(n, low_bits, [low, high, ones])

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ones]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U64)
        bit = i.astype(U64) * U64(self.low_bits)
        word, shift = (bit >> U64(6)).astype(np.int64), bit & U64(63)
        next_part = (self.low[word + 1] << U64(1)) << (U64(63) - shift)  # no shift by 64
        return (self.low[word] >> shift | next_part) & U64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The elements at the places `i`."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _place_in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(U64) << U64(self.low_bits) | self._low(i)).astype(np.int64)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many elements have a smaller high part than `high`."""
        want = high - 1  # the zero bit that ends the part before
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.clip(np.searchsorted(zeros, want, side="right") - 1, 0, len(self.high) - 1)
        place = word * 64 + _place_in_word(~self.high[word], want - zeros[word])
        return np.where(high <= 0, 0, np.where(want >= zeros[-1], self.n, place - want))

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of the first element >= each value (n: none): from the zero bit of its
        high part on, by bisection of the elements that share it."""
        high = (values.astype(U64) >> U64(self.low_bits)).astype(np.int64)
        low = (values.astype(U64) & U64((1 << self.low_bits) - 1))
        lo, hi = self._before(high), self._before(high + 1)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)


class Trie:
    """Contexts and their successors, each successor with a code, in memory-mapped levels.

    `contexts` (ascending) and `pointers` (the first successor of each) are monotone as they
    are; a successor is kept as its word plus `bases[context]`, the sum of the spans of the
    contexts before, so that the whole level is monotone: a search for one in its context is
    one successor search in that level.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, bases: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.bases, self.successors, self.codes = contexts, pointers, bases, successors, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> Trie:
        """From distinct (context, word) pairs in ascending order."""
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(context)).astype(np.int64)
        spans = word[ends - 1] + 1 if len(starts) else np.zeros(0, np.int64)
        bases = np.concatenate([[0], np.cumsum(spans)])[: len(starts)].astype(np.int64)
        level = word + np.repeat(bases, ends - starts)
        return cls(EliasFano.of(context[starts]), EliasFano.of(np.append(starts, len(context))), EliasFano.of(bases), EliasFano.of(level), codes)

    def mapped(self) -> Trie:
        """The same trie, its levels in an unnamed file of this task that is mapped read-only."""
        levels = [self.contexts, self.pointers, self.bases, self.successors]
        parts = [a for s in levels for a in s.arrays] + [self.codes]
        with tempfile.TemporaryFile() as f:
            at = []
            for a in parts:
                at.append((f.tell(), a.dtype, len(a)))
                f.write(a.tobytes().ljust(-(-a.nbytes // 8) * 8 + 8, b"\0"))
            f.flush()
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        read = [np.frombuffer(view, t, n, o) for o, t, n in at]
        own = [EliasFano(s.n, s.low_bits, read[3 * i : 3 * i + 3]) for i, s in enumerate(levels)]
        return Trie(*own, read[-1])

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each (context, word) among the successors, or -1.  A run of one context
        is looked up once."""
        out = np.full(len(context), -1, np.int64)
        if not self.contexts.n or not len(context):
            return out
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(context))))
        c = np.minimum(self.contexts.find(context[first]), self.contexts.n - 1)
        met = self.contexts.get(c) == context[first]
        base, begin, end = self.bases.get(c), self.pointers.get(c), self.pointers.get(c + 1)
        known = np.flatnonzero(met[run])
        run, value = run[known], base[run[known]] + word[known]
        place = self.successors.find(value)
        same = np.flatnonzero((place >= begin[run]) & (place < end[run]))
        same = same[self.successors.get(place[same]) == value[same]]
        out[known[same]] = place[same]
        return out

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each (context, word); 0 if the trie lacks it."""
        place = self.find(context, word)
        return np.where(place >= 0, self.codes[np.maximum(place, 0)] if len(self.codes) else 0, 0)
