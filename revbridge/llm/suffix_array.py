"""External induced sorting of suffixes with common-prefix values.

The suffixes of a text that start a rising run after a falling one (LMS suffixes)
are sorted first: their substrings are named in order, and where names repeat,
the string of names is sorted by the same induction again (or, once its alphabet
is too large for buckets to pay, by rank doubling).  All others are induced from
them in two passes: a suffix is filed under its first character in the order in
which the suffix behind it is met.  The files are priority queues by (character,
order): they carry suffix tuples (position, common prefix with the tuple before),
keep a bounded number of tuples in memory and the rest on disk.  Common prefixes
are carried along: two suffixes filed one after the other share one character
more than the least common prefix met between the suffixes behind them.

Work is done on whole buckets in numpy.  Orders and prefixes are exact up to the
`cap` asked for.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples kept in memory by one queue before its longest buckets go to disk.
QUEUE_TUPLES = 1 << 18
_FAR = np.iinfo(np.int32).max
#: A string of names is sorted by induction if a name occurs this often on average.
NAME_USES = 256


class DiskQueue:
    """First in, first out within a bucket; buckets are popped in any order.

    Holds (position, common prefix) tuples.  Above `tuples` in memory, the longest
    buckets are appended to an unnamed scratch file and read back when popped; the
    file is gone with the task.
    """

    def __init__(self, tuples: int = QUEUE_TUPLES):
        self.limit, self.held, self.file = tuples, 0, None
        self.parts: dict[int, list] = {}
        self.sizes: dict[int, int] = {}

    def push(self, bucket: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.setdefault(bucket, []).append((pos, lcp))
        self.sizes[bucket] = self.sizes.get(bucket, 0) + len(pos)
        self.held += len(pos)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for bucket in sorted(self.sizes, key=self.sizes.get, reverse=True):
            kept = []
            for part in self.parts[bucket]:
                if isinstance(part[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(np.ascontiguousarray(part[0], np.int64).tobytes())
                    self.file.write(np.ascontiguousarray(part[1], np.int32).tobytes())
                    part = (at, len(part[0]))
                kept.append(part)
            self.parts[bucket] = kept
            self.held -= self.sizes[bucket]
            self.sizes[bucket] = 0
            if self.held <= self.limit // 2:
                return

    def pop(self, bucket: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples filed under the bucket, in order; it is empty afterwards."""
        parts = self.parts.pop(bucket, None)
        if not parts:
            return None
        self.held -= self.sizes.pop(bucket)
        read = []
        for part in parts:
            if not isinstance(part[0], np.ndarray):
                at, n = part
                self.file.seek(at)
                part = np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(4 * n), np.int32)
            read.append(part)
        return (read[0] if len(read) == 1 else (np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read])))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Text:
    """A string of integers that ends with its only 0, with the shape of its suffixes."""

    def __init__(self, symbols: np.ndarray):
        self.s = symbols
        n = len(symbols)
        ends = np.concatenate([np.flatnonzero(symbols[1:] != symbols[:-1]), [n - 1]])
        lengths = np.diff(np.concatenate([[-1], ends]))
        rises = np.ones(len(ends), bool)  # the last symbol counts as rising
        rises[:-1] = symbols[ends[:-1] + 1] > symbols[ends[:-1]]
        self.rising = np.repeat(rises, lengths)
        self.run = (np.repeat(ends, lengths) - np.arange(n) + 1).astype(np.int32)  # symbols equal from here on
        self.lms = np.flatnonzero(self.rising[1:] & ~self.rising[:-1]) + 1
        self.sigma = int(symbols.max()) + 1


def name_substrings(t: Text) -> tuple[np.ndarray, int]:
    """Ranks (from 0, equal for equal ones) of the substrings from each LMS place to the next."""
    width = max(1, int(2 * t.sigma).bit_length())
    per_word = 63 // width
    stops = np.concatenate([t.lms[1:], t.lms[-1:]])  # inclusive
    lengths = stops - t.lms + 1
    symbol = 2 * t.s.astype(np.int64) + t.rising  # falling sorts before rising
    padded = np.concatenate([symbol, np.zeros(per_word, np.int64)])

    def word(rows: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for j in range(per_word):
            i = k * per_word + j
            out = out << width | np.where(i < lengths[rows], padded[np.minimum(t.lms[rows] + i, len(padded) - 1)], 0)
        return out

    rank = np.unique(word(np.arange(len(lengths)), 0), return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        longer = np.flatnonzero(lengths > k * per_word)
        if not len(longer):
            break
        sub = np.zeros(len(lengths), np.int64)
        sub[longer] = np.unique(word(longer, k), return_inverse=True)[1]
        rank = np.unique(rank * (int(sub.max()) + 1) + sub, return_inverse=True)[1].astype(np.int64)
        k += 1
    return rank, int(rank.max()) + 1


def rank_doubling(names: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of `names`, exact for their first `cap` names."""
    rank, n, k = names.astype(np.int64), len(names), 1
    while k < cap:
        count = int(rank.max()) + 1
        if count == n:
            break
        behind = np.zeros(n, np.int64)
        behind[:-k] = rank[k:] + 1
        rank = np.unique(rank * (n + 1) + behind, return_inverse=True)[1]
        k *= 2
        if k >= n:
            break
    return np.argsort(rank, kind="stable")


def lms_order(t: Text, cap: int) -> np.ndarray:
    """LMS places in the order of their suffixes."""
    names, count = name_substrings(t)
    if count == len(names):
        return t.lms[np.argsort(names)]
    if count <= len(names) // NAME_USES:
        order = np.concatenate([pos for pos, _ in induce(Text(names), cap)])[::-1]
    else:
        order = rank_doubling(names, cap // 2 + 2)  # LMS places are two apart at least
    return t.lms[order]


def common_prefixes(raw: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix, up to `cap` and more, of each suffix in `order` with the one before (0 for the first)."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(len(order), np.int32)
    live = np.arange(1, len(order))
    a, b = order[:-1].copy(), order[1:].copy()
    depth = 0
    while len(live) and depth < cap:
        inside = np.maximum(a, b) + depth < n
        live, a, b = live[inside], a[inside], b[inside]
        x = np.ascontiguousarray(words[a + depth]).view(np.uint64).ravel()
        y = np.ascontiguousarray(words[b + depth]).view(np.uint64).ravel()
        diff = x ^ y
        same = diff == 0
        first = np.zeros(len(live), np.int32)
        low = diff & (~diff + np.uint64(1))  # the lowest differing bit: bytes are little-endian
        first[~same] = (np.log2(low[~same].astype(np.float64)) // 8).astype(np.int32)
        out[live[~same]] = depth + first[~same]
        out[live[same]] = depth + 8
        live, a, b = live[same], a[same], b[same]
        depth += 8
    return out


class _Pass:
    """One induction pass: files the suffixes before those it is shown."""

    def __init__(self, t: Text, rising: bool, queue: DiskQueue):
        self.t, self.rising, self.queue = t, rising, queue
        self.least = np.zeros(t.sigma, np.int32)  # least common prefix met since a bucket was last filed to

    def show(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Meet suffixes in order; lcp: with the one met before."""
        before = pos - 1
        at = np.flatnonzero((pos > 0) & (self.t.rising[before] == self.rising))
        lowest = np.minimum.accumulate(lcp[::-1])[::-1]
        if len(at):
            symbols = self.t.s[before[at]]
            order = np.argsort(symbols, kind="stable")
            symbols, at = symbols[order], at[order]
            first = np.concatenate([[True], symbols[1:] != symbols[:-1]])
            starts = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
            spans = np.empty(2 * len(at), np.int64)
            spans[::2], spans[1::2] = starts, at + 1
            met = np.minimum.reduceat(np.concatenate([lcp, [_FAR]]).astype(np.int32), spans)[::2]
            heads = np.flatnonzero(first)
            met[heads] = np.minimum(met[heads], self.least[symbols[heads]])
            tails = np.concatenate([heads[1:], [len(at)]])
            np.minimum(self.least, lowest[0], out=self.least)
            rest = np.concatenate([lowest, [_FAR]])
            self.least[symbols[heads]] = rest[at[tails - 1] + 1]
            shared = np.where(met >= _FAR, _FAR, met + 1).astype(np.int32)
            places = before[at]
            for a, b in zip(heads.tolist(), tails.tolist()):
                self.queue.push(int(symbols[a]), places[a:b], shared[a:b])
        else:
            np.minimum(self.least, lowest[0], out=self.least)


def induce(t: Text, cap: int, raw: np.ndarray | None = None, queue_tuples: int = QUEUE_TUPLES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, in chunks (positions, common prefixes with the
    suffix before in this order).  Prefixes are meaningful only if `raw` (the text's
    bytes, for the LMS suffixes' prefixes) is given, and exact up to `cap`."""
    order = lms_order(t, cap) if len(t.lms) else np.array([len(t.s) - 1])
    seeds = common_prefixes(raw, order, cap) if raw is not None else np.zeros(len(order), np.int32)
    seed_symbols = t.s[order]
    buckets = np.unique(t.s)
    lo, hi = np.searchsorted(seed_symbols, buckets, "left"), np.searchsorted(seed_symbols, buckets, "right")
    falling_queue, rising_queue, sorted_falling = (DiskQueue(queue_tuples) for _ in range(3))
    rise = _Pass(t, False, falling_queue)
    for c, a, b in zip(buckets.tolist(), lo.tolist(), hi.tolist()):
        last = None
        while (got := falling_queue.pop(c)) is not None:
            pos, lcp = got
            if last is None:
                lcp = np.concatenate([[0], lcp[1:]]).astype(np.int32)
            sorted_falling.push(c, pos, lcp)
            last = pos[-1]
            rise.show(pos, lcp)
        if b > a:
            lcp = seeds[a:b].copy()
            lcp[0] = 0 if last is None else min(t.run[last], t.run[order[a]])
            rise.show(order[a:b], lcp)
    fall = _Pass(t, True, rising_queue)
    for c in buckets[::-1].tolist():
        last = None
        if c == 0:
            yield np.array([len(t.s) - 1]), np.zeros(1, np.int32)
            break
        while (got := rising_queue.pop(c)) is not None:
            pos, lcp = got
            if last is None:
                lcp = np.concatenate([[0], lcp[1:]]).astype(np.int32)
            yield pos, lcp
            last = pos[-1]
            fall.show(pos, lcp)
        if (got := sorted_falling.pop(c)) is not None:
            pos, lcp = got[0][::-1], np.concatenate([[0], got[1][:0:-1]]).astype(np.int32)
            if last is not None:
                lcp[0] = min(t.run[last], t.run[pos[0]])
            yield pos, lcp
            fall.show(pos, lcp)
    for q in (falling_queue, rising_queue, sorted_falling):
        q.close()


def repeated_starts(raw: bytes, width: int, queue_tuples: int = QUEUE_TUPLES) -> np.ndarray:
    """For each place of `raw`: does the string of `width` bytes there also start at another place?"""
    text = np.frombuffer(raw, np.uint8)
    out = np.zeros(len(text) + 1, bool)
    if len(text) < width:
        return out[:-1]
    symbols = np.zeros(len(text) + 1, np.int16)
    symbols[:-1] = text
    symbols[:-1] += 1
    previous = None
    for pos, lcp in induce(Text(symbols), width, text, queue_tuples):
        at = np.flatnonzero(lcp >= width)
        out[pos[at]] = True
        inner = at[at > 0]
        out[pos[inner - 1]] = True
        if len(at) and at[0] == 0 and previous is not None:
            out[previous] = True
        previous = pos[-1]
    out[max(0, len(text) - width + 1) :] = False
    return out[:-1]
