"""Suffix-array dedup: remove every byte of a string of `width` bytes that also starts elsewhere.

Sharding.  Each window of `width` bytes has an anchor, the place in it whose
GRAM-byte string has the least hash (the first of equal ones): equal windows have
equal anchors at equal offsets, so all windows of one anchor string can be judged
together.  Neighbouring windows with the same anchor form an instance: a snippet
of at most 2 * width bytes.

1. Scan: each window also holds the string of CORE bytes that ends with or starts
   at its anchor; cores are counted (map-side combined).  A Bloom filter of the
   repeated ones, of bounded size, tells the second scan which windows cannot be
   repeated; the filter's errors only let a few more pass.
2. Instances with the same anchor and the same snippet are repeats of each other
   as a whole: copies are settled by a count, however many there are.
3. What is left are snippets that agree with others in part.  The distinct ones of
   an anchor go to one shard of about SHARD_BYTES, and the shard's suffixes are
   sorted by external induced sorting with common prefixes (`suffix_array`): a
   window repeats if a neighbour in that order shares `width` bytes.  Anchors with
   very many distinct snippets are split: their windows are cut into blocks of
   SPLIT neighbouring starts, and dealt by the bytes that all windows of a block
   hold, after equal blocks have been settled by a count as in 2.  Where even the
   blocks of one shard are too many (they lie across the edge of a passage that many
   documents hold), their windows are counted one by one instead of sorted.
4. The intervals found go to their documents, which are cut and digested.

The text is shuffled compressed (twice), and never gathered: a task holds one
document, one scan buffer or one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch, row_key
from revbridge.llm.suffix_array import repeated_starts

GRAM = 32
#: Bytes scanned at a time, and bits for a place in them.
SCAN_BYTES = 1 << 19
_PLACE_BITS = np.uint64(20)
#: Text of one shard; anchors whose distinct snippets pass a quarter of it are split into
#: blocks of so many window starts.
SHARD_BYTES = 2 << 20
SPLIT = 24
#: Rows from which a kind may count as hot, and how many hot kinds there can be.
HOT_USES, MAX_HOT = 1000, 10_000
#: Blocks whose windows are counted at a time.
COUNTED_AT_ONCE = 500
#: The Bloom filter: 512-bit blocks, at most 2^18 of them (16 MB) are sent out.
MAX_BLOCKS = 1 << 18
BITS_PER_KEY = 16
PROBES = 4

_rng = np.random.default_rng(200)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_MULT = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def core_bytes(width: int) -> int:
    """Every window holds the gram and half of the rest on one side of it."""
    return GRAM + (width - GRAM) // 2


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    w = 1
    while 2 * w <= n:
        x = np.minimum(x[:-w], x[w:])
        w *= 2
    return np.minimum(x[: len(x) - (n - w)], x[n - w :]) if w < n else x


class Windows:
    """The instances of a buffer of several documents' bytes."""

    def __init__(self, raw: bytes, ends: np.ndarray, width: int):
        """ends: where each document ends in `raw`."""
        buf = np.frombuffer(raw, np.uint8)
        h, w = _BYTE[buf], 1
        for m in _MULT[:5]:  # strings of 2, 4, .. 32 bytes
            h = h[:-w] * m + h[w:]
            w *= 2
        core = core_bytes(width)
        step = core - GRAM  # a core is hashed from grams that cover it
        covering = [*range(0, step, GRAM), step]
        gram = _mix(h)
        key = (gram >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(gram), dtype=np.uint64)
        least = _sliding_min(key, width - GRAM + 1)
        starts = np.concatenate([[0], ends[:-1]])
        long = ends - starts >= width
        inside = np.zeros(len(raw) + 1, np.int64)
        np.add.at(inside, starts[long], 1)
        np.add.at(inside, ends[long] - width + 1, -1)
        s = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
        place = (least[s] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        doc = np.searchsorted(ends, s, "right")
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])) if len(s) else s
        self.anchor = gram[place[new]]
        self.place, self.doc = place[new], doc[new]
        self.first = s[new]
        self.last = s[np.concatenate([new[1:] - 1, [len(s) - 1]])] if len(s) else s
        # the core that ends with the gram, held by windows from `first` to place - step,
        # and the one that starts with it, held by the others
        self.left_last = np.minimum(self.last, self.place - step)
        self.right_first = np.maximum(self.first, self.place - step + 1)
        self.has_left, self.has_right = self.left_last >= self.first, self.right_first <= self.last
        self.left = self._core(gram, np.where(self.has_left, self.place - step, 0), covering)
        self.right = ~self._core(gram, np.where(self.has_right, self.place, 0), covering)

    @staticmethod
    def _core(gram: np.ndarray, at: np.ndarray, covering: list[int]) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for c in covering:
            h = h * _MULT[6] + gram[np.minimum(at + c, len(gram) - 1)]
        return _mix(h)


def _buffers(texts: list[bytes], width: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts, or pieces of long ones that overlap by width - 1 bytes, in buffers of about
    SCAN_BYTES: (bytes, ends, row of each piece, its place in the text)."""
    held, rows, places, size = [], [], [], 0
    step = SCAN_BYTES - width

    def full():
        return b"".join(held), np.cumsum([len(x) for x in held]), np.array(rows), np.array(places)

    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - width + 1), step):
            piece = t[at : at + step + width - 1]
            if len(piece) < width:
                continue
            if size + len(piece) > SCAN_BYTES and held:
                yield full()
                held, rows, places, size = [], [], [], 0
            held.append(piece)
            rows.append(row)
            places.append(at)
            size += len(piece)
    if held:
        yield full()


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of a batch of a few MB: (first row, texts as bytes)."""
    col = batch.column(column).cast(pa.binary())
    out, first, size = [], 0, 0
    for i, t in enumerate(col):
        t = t.as_py() or b""
        out.append(t)
        size += len(t)
        if size > 4 * SCAN_BYTES:
            yield first, out
            out, first, size = [], i + 1, 0
    if out:
        yield first, out


def _repeated_cores(rows: DataFrame, width: int) -> DataFrame:
    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _texts(batch, "text"):
                for raw, ends, _, _ in _buffers(texts, width):
                    w = Windows(raw, ends, width)
                    keys = np.concatenate([w.left[w.has_left], w.right[w.has_right]])
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["core"])

    found = rows.select("text").mapInArrow(cores, "core long")
    return found.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")


def _bloom(cores: DataFrame) -> np.ndarray:
    """(blocks, 8) words; bounded by MAX_BLOCKS whatever the number of cores."""
    n = cores.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 512 < n * BITS_PER_KEY:
        blocks *= 2
    bits = [F.shiftrightunsigned("core", 63 - 9 * (i + 1)).bitwiseAND(F.lit(511)) for i in range(PROBES)]
    one = F.lit(1).cast("long")
    mask = lambda b, w: F.when(F.shiftright(b, 6) == w, F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long"))
    words = []
    for w in range(8):
        word = F.lit(0).cast("long")
        for b in bits:
            word = word.bitwiseOR(mask(b, w))
        words.append(word.alias(f"w{w}"))
    rows = cores.select(F.col("core").bitwiseAND(F.lit(blocks - 1)).alias("block"), *words)
    got = rows.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(8)]).toArrow()
    table = np.zeros((blocks, 8), np.uint64)
    block = got.column("block").to_numpy()
    for w in range(8):
        table[block, w] = got.column(f"w{w}").to_numpy().view(np.uint64)
    return table


def _maybe_repeated(table: np.ndarray, cores: np.ndarray) -> np.ndarray:
    block = (cores & np.uint64(len(table) - 1)).astype(np.int64)
    out = np.ones(len(cores), bool)
    for i in range(PROBES):
        bit = cores >> np.uint64(63 - 9 * (i + 1)) & np.uint64(511)
        out &= (table[block, (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


_INSTANCE = "k1 long, k2 long, anchor long, snippet long, first long, n int, offset int"


def _instances(rows: DataFrame, width: int, sent) -> DataFrame:
    """Windows that may repeat, as instances: the row's key, the anchor, the snippet's
    digest, its first window, the number of its windows, and the anchor's offset."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for row0, texts in _texts(batch, "text"):
                for raw, ends, rows_, places in _buffers(texts, width):
                    w = Windows(raw, ends, width)
                    left = w.has_left & _maybe_repeated(table, w.left)
                    right = w.has_right & _maybe_repeated(table, w.right)
                    keep = np.flatnonzero(left | right)
                    if not len(keep):
                        continue
                    # only the side whose core repeats
                    first = np.where(left, w.first, w.right_first)[keep]
                    last = np.where(right, w.last, w.left_last)[keep]
                    place, doc = w.place[keep], w.doc[keep]
                    digest = xxhash.xxh3_64_intdigest
                    snippet = np.array([digest(raw[a : b + width], c - a) for a, b, c in zip(first.tolist(), last.tolist(), place.tolist())], np.uint64)
                    row = rows_[doc] + row0
                    starts = np.concatenate([[0], ends[:-1]])[doc]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(k1[row]), pa.array(k2[row]), pa.array(w.anchor[keep].view(np.int64)), pa.array(snippet.view(np.int64)),
                        pa.array(first - starts + places[doc]), pa.array((last - first + 1).astype(np.int32)), pa.array((place - first).astype(np.int32)),
                    ], ["k1", "k2", "anchor", "snippet", "first", "n", "offset"])

    return rows.select("k1", "k2", "text").mapInArrow(scan, _INSTANCE)


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle, with the row's key and `doc_id`."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, texts in _texts(batch, "text"):
                part = batch.slice(row0, len(texts))
                data = [pa.compress(t, "zstd", asbytes=True) if t else b"" for t in texts]
                sizes = [len(t) for t in texts]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "k1", "k2")), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "k1", "k2", "size", "data"])

    return rows.select("doc_id", "k1", "k2", "text").mapInArrow(pack, f"doc_id {kind}, k1 long, k2 long, size long, data binary")


def _unpack(size: int, data: bytes) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True) if size else b""


def _blocks(text: bytes, x: dict, width: int) -> Iterator[tuple[int, int, bytes]]:
    """An instance's windows [lo, hi) and the bytes that decide their shard: all of
    it, or if its anchor is split, blocks of SPLIT starts (counted from the anchor,
    so that equal windows fall into equal blocks) with the bytes common to a block."""
    first, stop = x["first"], x["first"] + x["n"]
    if not x["split"]:
        yield first, stop, b""
        return
    place = first + x["offset"]
    for k in range((first - place) // SPLIT, (stop - 1 - place) // SPLIT + 1):
        start = place + SPLIT * k
        yield max(first, start), min(stop, start + SPLIT), b"%d:" % k + text[start + SPLIT - 1 : start + width]


_SNIPPET = "k1 long, k2 long, shard long, first long, split boolean, snippet binary"


def _snippets(packed: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """The bytes of the asked instances, dealt to shards."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                text = _unpack(row["size"], row["data"])
                out = []
                for x in row["asked"]:
                    for lo, hi, by in _blocks(text, x, width):
                        shard = xxhash.xxh64_intdigest(by, x["anchor"] & (2**64 - 1)) >> 1
                        out.append((row["k1"], row["k2"], shard, lo, x["split"], text[lo : hi + width - 1]))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.bool_()), pa.array(cols[5], pa.binary())],
                    ["k1", "k2", "shard", "first", "split", "snippet"],
                )

    joined = packed.join(asked, ["k1", "k2"]).select("k1", "k2", "size", "data", "asked")
    return joined.mapInArrow(cut, _SNIPPET)


def _of_kinds(rows: DataFrame, kinds: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `kinds` (`keys`, `uses`: their number in `rows`).  A kind with very many rows
    would meet them in one task: those (at most MAX_HOT, by the threshold) are sent out instead."""
    total = kinds.agg(F.sum("uses")).first()[0] or 0
    hot = F.col("uses") > max(HOT_USES, total // MAX_HOT)
    few = F.broadcast(kinds.filter(hot).select(*keys, F.lit(True).alias("_hot")))
    marked = rows.join(few, keys, "left")
    rest = marked.filter("_hot IS NULL").join(kinds.filter(~hot).select(*keys), keys, "left_semi")
    return marked.filter("_hot").unionByName(rest).drop("_hot")


def _settled_blocks(blocks: DataFrame, width: int, scratch: Scratch, most: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of split anchors: the intervals that a count settles, and one of each kind where a
    shard has several and some kind is met only once.

    Equal blocks repeat as a whole.  A shard of more than `most` bytes, as the blocks across the
    edge of a passage that many documents hold (equal where they decide the shard, each with its
    own neighbours), is settled window by window: a digest of each is counted, map-side first."""
    digest = F.xxhash64("snippet")
    kinds = scratch.stage(
        blocks.groupBy("shard", digest.alias("digest"))
        .agg(F.count("*").alias("uses"), F.min(F.struct("k1", "k2", "first", "snippet")).alias("x"))
    )
    equal = _of_kinds(blocks.withColumn("digest", digest), kinds.filter("uses > 1").select("shard", "digest", "uses"), ["shard", "digest"])
    equal = equal.select("k1", "k2", F.col("first").alias("lo"), (F.col("first") + F.octet_length("snippet")).alias("hi"))
    shards = kinds.groupBy("shard").agg(F.count("*").alias("kinds"), F.min("uses").alias("least"), F.sum(F.octet_length("x.snippet")).alias("bytes"))
    mixed = kinds.join(shards.filter("kinds > 1 and least = 1").select("shard", (F.col("bytes") > most).alias("large")), "shard")
    mixed = scratch.stage(mixed.select("x.k1", "x.k2", "shard", "x.first", "x.snippet", "uses", "large"))
    counted = _counted_windows(mixed.filter("large"), width, scratch)
    return equal.unionByName(counted), mixed.filter("not large").select("k1", "k2", "shard", "first", "snippet")


def _counted_windows(kinds: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """The intervals of windows met more than once among block kinds and their uses."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED_AT_ONCE):
                part = batch.slice(at, COUNTED_AT_ONCE)
                texts = part.column("snippet").to_pylist()
                starts = np.array([len(t) - width + 1 for t in texts])
                both = np.frombuffer(b"".join([digest(t[i : i + width]) for t in texts for i in range(len(t) - width + 1)]), np.int64).reshape(-1, 2)
                inside = np.arange(len(both)) - np.repeat(np.cumsum(starts) - starts, starts)
                k1, k2, first, uses = (np.repeat(part.column(c).to_numpy(), starts) for c in ("k1", "k2", "first", "uses"))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k1, k2, first + inside, uses, both[:, 0], both[:, 1])], ["k1", "k2", "at", "n", "d1", "d2"])

    fields = "k1 long, k2 long, at long, n long, d1 long, d2 long"
    found = scratch.stage(kinds.select("k1", "k2", "first", "snippet", "uses").mapInArrow(windows, fields))
    again = found.groupBy("d1", "d2").agg(F.sum("n").alias("n"), F.count("*").alias("uses")).filter("n > 1")
    again = scratch.stage(again.select("d1", "d2", "uses"))
    hit = _of_kinds(found.filter("n = 1"), again, ["d1", "d2"])  # kinds met several times are settled as a whole
    return hit.select("k1", "k2", F.col("at").alias("lo"), (F.col("at") + width).alias("hi"))


def _sorted_shards(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows ordered by shard -> the intervals of bytes that repeat."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        raw = b"\xff".join(x[3] for x in held)  # no byte of UTF-8
        again = repeated_starts(raw, width).view(np.int8)
        edges = np.flatnonzero(np.diff(again, prepend=0, append=0))
        starts = np.cumsum([0] + [len(x[3]) + 1 for x in held])
        out = []
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            i = int(np.searchsorted(starts, lo, "right")) - 1
            while lo < hi:  # windows across a separator are repeats of nothing real
                size = len(held[i][3])
                a, b = max(lo - int(starts[i]), 0), min(hi - int(starts[i]), size - width + 1)
                if a < b:
                    out.append((held[i][0], held[i][1], held[i][2] + a, held[i][2] + b - 1 + width))
                i += 1
                lo = int(starts[i]) if i < len(held) else hi
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["k1", "k2", "lo", "hi"])

    held, shard = [], None
    for batch in batches:
        for r in range(batch.num_rows):
            s = batch.column("shard")[r].as_py()
            if s != shard and held:
                yield solve(held)
                held = []
            shard = s
            held.append(tuple(batch.column(c)[r].as_py() for c in ("k1", "k2", "first", "snippet")))
    if held:
        yield solve(held)


def remove_repeats(docs: DataFrame, width: int = 200, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """Remove each byte covered by a `width`-byte string that also starts elsewhere in `docs`.

    Returns a row per row: `doc_id`, `n_bytes`, `n_removed`, `n_spans` (maximal removed
    runs), `kept_sha256` of the rest, and with `keep_text` the rest (`kept`, binary)
    and the removed `spans` (start, end).  Texts are their UTF-8 bytes, null ones
    empty; strings never cross texts; all are judged on the input.  Rows of equal
    content are repeats of each other; a null doc_id stays null; other columns play
    no part; no rows give none.  width must be at least GRAM + 2.
    """
    if width < GRAM + 2:
        raise ValueError(f"width must be at least {GRAM + 2}")
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", "text", *row_key(F.col("doc_id"), F.col("text")))
    cores = scratch.stage(_repeated_cores(rows, width))
    sent = docs.sparkSession.sparkContext.broadcast(_bloom(cores))
    found = scratch.stage(_instances(rows, width, sent))
    # equal snippets of an anchor repeat as a whole
    kinds = scratch.stage(found.groupBy("anchor", "snippet").agg(F.count("*").alias("uses"), F.min(F.struct("k1", "k2", "first", "n", "offset")).alias("x")))
    whole = _of_kinds(found, kinds.filter("uses > 1").select("anchor", "snippet", "uses"), ["anchor", "snippet"])
    whole = whole.select("k1", "k2", F.col("first").alias("lo"), (F.col("first") + F.col("n") - 1 + width).alias("hi"))
    # anchors with snippets of their own beside others
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("uses").alias("least"), F.sum(F.col("x.n") + width).alias("bytes"))
    mixed = mixed.filter("kinds > 1 and least = 1").select("anchor", (F.col("bytes") > SHARD_BYTES // 4).alias("split"))
    open_kinds = kinds.join(mixed, "anchor").select("anchor", "split", "x.*")
    asked = open_kinds.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "split", "first", "n", "offset")).alias("asked"))
    packed = _packed(rows)
    snippets = scratch.stage(_snippets(packed.dropDuplicates(["k1", "k2"]), asked, width))  # equal rows share a key
    equal, open_blocks = _settled_blocks(snippets.filter("split"), width, scratch, SHARD_BYTES // 4)
    open_text = snippets.filter("not split").drop("split").unionByName(open_blocks)
    size = open_text.agg(F.sum(F.octet_length("snippet"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    dealt = open_text.withColumn("shard", F.pmod("shard", F.lit(shards))).repartition("shard").sortWithinPartitions("shard")
    part = dealt.select("k1", "k2", "shard", "first", "snippet").mapInArrow(lambda it: _sorted_shards(it, width), "k1 long, k2 long, lo long, hi long")
    gone = whole.unionByName(equal).unionByName(part).distinct()  # equal rows have equal intervals
    gone = gone.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = ", kept binary, spans array<struct<start:long,end:long>>" if keep_text else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone_col = batch.column("gone")
            offsets = gone_col.offsets.to_numpy()
            lo = gone_col.values.field("lo").to_numpy(zero_copy_only=False)
            hi = gone_col.values.field("hi").to_numpy(zero_copy_only=False)
            out = []
            for r in range(batch.num_rows):
                data = _unpack(batch.column("size")[r].as_py(), batch.column("data")[r].as_py())
                spans = _merged(lo[offsets[r] : offsets[r + 1]], hi[offsets[r] : offsets[r + 1]])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                rest = b"".join(kept)
                row = [len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()]
                out.append(row + [rest, [{"start": a, "end": b} for a, b in spans]] * keep_text)
            kinds_ = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"][: 4 + 2 * keep_text]
            cols = [pa.array([x[i] for x in out], kinds_[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", *names])

    final = packed.join(gone, ["k1", "k2"], "left").select("doc_id", "size", "data", "gone")
    return final.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}")


def _merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of [lo, hi)."""
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:] - 1, [len(lo) - 1]])
    return list(zip(lo[starts].tolist(), reach[ends].tolist()))
