"""SimHash near-duplicates, compared bit-sliced.

Every text gets a 64-bit fingerprint.  Equal fingerprints are collapsed first, so
groups of copies cost one row.  Distinct fingerprints that agree in two of
radius + 2 bands (two within the radius must) meet in a run; inside a run the
fingerprints are stored vertically, 64 of them to a block, one machine word per
bit position.  Fingerprints are then compared with whole blocks: the difference
words of three planes at a time go through a carry-save adder into bitwise
counters, and a block is abandoned once all its 64 distances exceed the radius.
Each task keeps only a spanning forest of the links it has found; components of
the forests are those of all links.

A run that is too long for one task is cut into tiles, and each pair of tiles is
compared once, so memory is bounded by the tile and the batch, and no pair of
documents is ever written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch, as_row, row_key
from revbridge.llm.components import connected_components

SEED = 42
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows of a run that one task compares against each other.
TILE = 8192
#: (fingerprint, block) pairs compared at a time.
BATCH = 1 << 18

_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text: a bit is 1 if set in over half the hashes of its word
    shingles (repeats included).  A-Z count as a-z.  Fewer words than a shingle:
    the whole sequence is one shingle; no words or null: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # one past the space behind each word
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros((8, 8), np.int64)
    for k in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + (1 << 16)], stops[k : k + (1 << 16)])]
        octets = np.array(part, np.uint64).view(np.uint8).reshape(-1, 8)
        for i in range(8):
            set_bits[i] += np.bincount(octets[:, i], minlength=256) @ _BIT_OF_BYTE
    bits = (2 * set_bits.ravel() > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, out: str, shingle: int = 3) -> DataFrame:
    """Add `out`, the fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            values = np.fromiter((fingerprint(x, shingle) for x in t), np.uint64, len(t))
            yield pd.Series(values.view(np.int64))

    return docs.withColumn(out, fp(F.col(text)))


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, blocks) words: bit j of word [p, b] is bit p of fingerprint 64 b + j."""
    blocks = -(-len(fps) // 64)
    padded = np.zeros(blocks * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(blocks, 64, 8), axis=2, bitorder="little")  # block, j, plane
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")  # plane, block, 8 bytes
    return np.ascontiguousarray(packed).view(np.uint64).reshape(64, blocks)


def within(planes: np.ndarray, fps: np.ndarray, blocks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare fps[i] with block blocks[i]: returns (i, word), for the pairs where some
    of the 64 are within the radius, with their bits set in the word.

    The counters start at 2^k - 1 - radius, so the carry out of the top one says
    that the distance has passed the radius; it stays in `over`.
    """
    k = max(1, int(radius).bit_length())
    start = (1 << k) - 1 - radius
    live = np.arange(len(fps))
    counters = [np.full(len(fps), FULL if start >> b & 1 else 0, np.uint64) for b in range(k)]
    over = np.zeros(len(fps), np.uint64)

    def differ(p: int) -> np.ndarray:
        mine = np.uint64(0) - (fps[live] >> np.uint64(p) & np.uint64(1))  # all ones or none
        return planes[p, blocks[live]] ^ mine

    def add(word: np.ndarray, level: int) -> None:
        for b in range(level, k):
            counters[b], word = counters[b] ^ word, counters[b] & word
        np.bitwise_or(over, word, out=over)

    for p in range(0, 63, 3):
        x, y, z = differ(p), differ(p + 1), differ(p + 2)
        ones, twos = x ^ y ^ z, (x & y) | (z & (x ^ y))  # carry-save adder
        add(ones, 0)
        add(twos, 1)
        if p % 12 == 9:
            keep = np.flatnonzero(over != FULL)
            if len(keep) < len(live):
                live, over = live[keep], over[keep]
                counters = [c[keep] for c in counters]
                if not len(live):
                    return live, over
    add(differ(63), 0)
    keep = np.flatnonzero(over != FULL)
    return live[keep], ~over[keep]


class Forest:
    """Union-find over places in an array, many links at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if np.array_equal(higher, self.up):
                return higher
            self.up = higher

    def join(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Join a[i] with b[i]; yields the links that joined two trees."""
        while True:
            roots = self.roots()
            x, y = roots[a], roots[b]
            apart = np.flatnonzero(x != y)
            if not len(apart):
                return
            a, b = a[apart], b[apart]
            high, low = np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart])
            order = np.lexsort((low, high))
            pick = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]  # one lower tree for each
            self.up[high[pick]] = low[pick]
            yield a[pick], b[pick]


def run_links(runs: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside the runs (rows sorted by run), as two arrays of places."""
    n = len(fps)
    change = np.flatnonzero(np.concatenate([runs[1:] != runs[:-1], [True]])) + 1
    lengths = np.diff(np.concatenate([[0], change]))
    last = np.repeat(change - 1, lengths)  # last row of each row's run
    planes = bit_planes(fps)
    rows = np.flatnonzero(np.arange(n) < last)
    first_block, n_blocks = rows // 64, last[rows] // 64 - rows // 64 + 1
    forest, at = Forest(n), 0
    out: list[tuple[np.ndarray, np.ndarray]] = [(rows[:0], rows[:0])]
    totals = np.cumsum(n_blocks)
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(totals, (totals[at - 1] if at else 0) + BATCH, "right")))
        count = n_blocks[at:upto]
        i = np.repeat(rows[at:upto], count)
        step = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        block = np.repeat(first_block[at:upto], count) + step
        hit, words = within(planes, fps[i], block, radius)
        left, base = i[hit], block[hit] * 64
        for j in range(64):
            some = np.flatnonzero(words >> np.uint64(j) & np.uint64(1))
            a, b = left[some], base[some] + j
            real = (b > a) & (b <= last[a])
            out += forest.join(a[real], b[real])
        at = upto
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole runs, sorted by run; a run's two tiles lie together."""

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        cols = [t.column(c).to_numpy() for c in ("band", "key", "tile")]
        fps = t.column("fp").to_numpy().view(np.uint64)
        edge = np.zeros(len(fps), bool)
        for c in cols:
            edge[1:] |= c[1:] != c[:-1]
        a, b = run_links(np.cumsum(edge), fps, radius)
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[a]), pa.array(signed[b])], ["a", "b"])

    def run_of(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(c)[row].as_py() for c in ("band", "key", "tile"))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if sum(b.num_rows for b in held) >= 4 * TILE:
            # hold back the rows of the last run: the next batch may go on with it
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cut, run = t.num_rows, run_of(t, t.num_rows - 1)
            cols = [t.column(c).to_numpy() for c in ("band", "key", "tile")]
            same = np.ones(t.num_rows, bool)
            for c, v in zip(cols, run):
                same &= c == v
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield links([t.slice(0, cut)])
                held = [t.slice(cut)]
            else:
                held = [t]
        held.append(batch)
    if held:
        yield links(held)


def fingerprint_links(fps: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (`fp` long) -> links (`a`, `b`) that connect every two
    within `radius` bits of each other (a spanning forest per run, not all pairs).

    Runs: the 64 bits are cut into radius + 2 bands; two fingerprints within the
    radius agree in two bands at least, so they meet under some pair of bands.
    A run over `tile` rows is dealt into tiles by hash, and every pair of its
    tiles becomes a run; the runs to be cut are found by a combined count.
    """
    n_bands = radius + 2
    cuts = [64 * i // n_bands for i in range(n_bands + 1)]
    masks = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(n_bands)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = [
        F.struct(F.lit(n).alias("band"), F.col("fp").bitwiseAND(F.lit(signed(masks[i] | masks[j]))).alias("key"))
        for n, (i, j) in enumerate(combinations(range(n_bands), 2))
    ]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.band", "k.key")
    sizes = rows.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    met = rows.join(sizes.select("band", "key", tiles.alias("tiles")), ["band", "key"])
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.least(t, F.col("mine")) * F.col("tiles") + F.greatest(t, F.col("mine")),
    )
    met = met.withColumn("mine", mine).select("fp", "band", "key", F.explode(pairs).alias("tile"))
    dealt = met.repartition("band", "key", "tile").sortWithinPartitions("band", "key", "tile")
    return dealt.mapInArrow(lambda it: _compare(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(`doc_id`, `fp` long, `component_id`) for every row of `docs`.

    component_id is the smallest doc_id among the rows whose fingerprints are
    reachable by links of at most `radius` bits; fingerprint 0 (no words, null
    text) links like any other.  A row with a null doc_id keeps it, and takes part
    in linking without naming a component; where no row of a component has an id,
    component_id is null.  Repeated rows are all returned.  No rows give none.
    """
    prints = scratch.stage(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "_t", "fp", shingle).drop("_t"))
    classes = scratch.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    members = connected_components(fingerprint_links(classes.select("fp"), radius), scratch)
    named = classes.join(members.withColumnRenamed("vertex", "fp"), "fp", "left")
    named = named.select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    lows = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    lookup = named.join(lows, "component").select("fp", "component_id")
    return prints.join(lookup, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Keep one document of every group: the one with the smallest doc_id, then the
    smallest content key (a group without any doc_id keeps one as well).  Rows
    equal in all columns of the key count once."""
    scratch = Scratch(docs.sparkSession)
    key = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(*key, "doc_id", "text")
    prints = scratch.stage(with_fingerprint(keyed, "text", "fp", shingle).drop("text"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("best")
    classes = scratch.stage(prints.groupBy("fp").agg(best))
    members = connected_components(fingerprint_links(classes.select("fp"), radius), scratch)
    named = classes.join(members.withColumnRenamed("vertex", "fp"), "fp", "left")
    kept = named.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("best").alias("best"))
    kept = kept.select("best.k1", "best.k2")
    rows = as_row(docs, k1=key[0], k2=key[1])
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
