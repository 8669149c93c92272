"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to length 1, turned by a random rotation and reduced to the
signs of its components: D bits, and one correction scalar, the inner product of
the code (a unit vector of components +-1/sqrt(D)) with the vector it stands
for.  <code, query> / <code, vector> estimates <vector, query> without bias, and
its error is bounded, with high probability, by a multiple of
sqrt((1 - c^2) / (c^2 (D - 1))), c the correction scalar.  The query is rounded
to `QUERY_BITS` bits a component, so <code, query> is a sum of popcounts of
ANDed words; what the rounding can add is bounded exactly and joins the error.

For each query and block of codes, vectors whose upper bound reaches the k-th
best lower bound (or the k-th best exact value found before) are reranked by the
exact cosine of the original vectors; nothing else is.

Every vector is coded and every code is compared with every query: the rotation
depends on the dimension alone, so there is no sample and no list to probe.
Queries go out in blocks of `QUERY_BLOCK` (bounded, whatever their number), the
index is a staged table read once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revbridge.llm.common import Scratch, global_index

QUERY_BITS = 8
#: Queries broadcast at a time (QUERY_BLOCK * dimension * 8 bytes).
QUERY_BLOCK = 4096
#: Codes compared with all queries of a block at a time.
CODE_BATCH = 512
#: Standard errors of the estimate that the bound spans.
EPSILON = 3.0
#: Above what two orders of summing can differ by in a cosine.
MARGIN = 1e-9


def rotation(dim: int, seed: int = 10) -> np.ndarray:
    """A random rotation of `dim` dimensions (a fixed function of dim and seed)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, words) packed sign bits and the correction scalars of unit vectors."""
    turned = vectors @ turn
    dim = turned.shape[1]
    bits = np.zeros((len(turned), -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned > 0
    words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return words, np.abs(turned).sum(axis=1) / np.sqrt(dim)


class QueryBlock:
    """Queries rounded to bit planes, with what an estimate needs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray):
        self.ids = ids
        self.vectors, self.norms = scaled(vectors)
        turned = unit(vectors) @ turn
        dim = turned.shape[1]
        self.dim = dim
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << QUERY_BITS) - 1), 1e-12)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + level * self.step[:, None]
        self.total = rounded.sum(axis=1)
        self.slack = np.abs(turned - rounded).sum(axis=1) / np.sqrt(dim)
        bits = np.zeros((QUERY_BITS, len(ids), -(-dim // 64) * 64), np.uint8)
        for b in range(QUERY_BITS):
            bits[b, :, :dim] = level >> b & 1
        self.planes = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)

    def estimate(self, words: np.ndarray, correction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, codes) estimates of the cosine and bounds of their errors."""
        bits = np.zeros((len(self.ids), len(words)), np.int64)
        for b in range(QUERY_BITS):
            for w in range(words.shape[1]):
                bits += np.bitwise_count(self.planes[b, :, w, None] & words[None, :, w]).astype(np.int64) << b
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        # the code's components are (2 bit - 1) / sqrt(dim), the query's low + step * level
        positive = self.low[:, None] * ones[None, :] + self.step[:, None] * bits
        code_dot = (2 * positive - self.total[:, None]) / np.sqrt(self.dim)
        spread = EPSILON * np.sqrt(np.maximum(0, 1 - correction**2) / max(1, self.dim - 1))
        return code_dot / correction, (spread[None, :] + self.slack[:, None]) / correction


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each, which changes no digit but lets no square overflow or
    vanish, and their norms, summed component by component."""
    out = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    squares = np.zeros(len(out))
    for d in range(out.shape[1]):
        squares += out[:, d] * out[:, d]
    return out, np.sqrt(squares)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of a[i] and b[i] in double precision, summed component by component."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class Nearest:
    """The best k (score, smaller id first) so far of each query of a block."""

    def __init__(self, block: QueryBlock, k: int):
        self.block, self.k = block, k
        self.scores = np.full((len(block.ids), k), -np.inf)
        self.ids = np.full((len(block.ids), k), np.iinfo(np.int64).max)
        self.reranked = 0

    def add(self, ids: np.ndarray, words: np.ndarray, correction: np.ndarray, vectors: np.ndarray) -> None:
        guess, error = self.block.estimate(words, correction)
        own = self.block.ids[:, None] == ids[None, :]
        upper = np.where(own, -np.inf, guess + error)
        floor = self.scores[:, -1]
        if len(ids) > self.k:
            lower = np.where(own, -np.inf, guess - error)
            floor = np.maximum(floor, np.partition(lower, -self.k, axis=1)[:, -self.k])
        q, c = np.nonzero((upper >= floor[:, None]) & ~own)
        self.reranked += len(q)
        vectors, norms = scaled(vectors)  # once a row, not once a pair
        # one product for the batch tells which candidates can rank (its rounding is far below the
        # margin); these alone are summed in the fixed order that scores and ties are judged by
        close = (self.block.vectors @ vectors.T)[q, c] / (self.block.norms[q] * norms[c])
        rank = close >= self.scores[q, -1] - MARGIN
        q, c = q[rank], c[rank]
        exact = inner(self.block.vectors[q], vectors[c]) / (self.block.norms[q] * norms[c])
        better = exact >= self.scores[q, -1]
        q, exact, found = q[better], exact[better], ids[c[better]]
        rows = np.concatenate([np.repeat(np.arange(len(self.block.ids)), self.k), q])
        scores = np.concatenate([self.scores.ravel(), exact])
        every = np.concatenate([self.ids.ravel(), found])
        order = np.lexsort((every, -scores, rows))
        starts = np.searchsorted(rows[order], np.arange(len(self.block.ids)))
        best = order[starts[:, None] + np.arange(self.k)[None, :]]
        self.scores, self.ids = scores[best], every[best]


def _floats(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places of the rows that have it)."""
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n)


def build_index(vectors: DataFrame, vec_id: str, embedding: str, scratch: Scratch) -> DataFrame:
    """Stage `vec_id`, `vector` (packed doubles), `code` (packed bits) and `correction`
    of every vector that takes part: id not null, vector not null, not empty or zero, all
    components non-null and finite.  Each length has its own rotation."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    good = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), x.alias("x"))
    good = good.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    good = good.filter(F.expr("size(x) > 0") & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    good = good.filter(F.exists("x", lambda v: v != 0))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column("x")
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for n, at in _by_length(np.diff(ends)):
                turn = turns[n] if n in turns else turns.setdefault(n, rotation(n))
                v = flat[ends[at][:, None] + np.arange(n)]
                words, correction = encode(unit(v), turn)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)), pa.array([r.tobytes() for r in v], pa.binary()), pa.array([r.tobytes() for r in words], pa.binary()), pa.array(correction)],
                    ["vec_id", "vector", "code", "correction"],
                )

    return scratch.stage(good.mapInArrow(code, "vec_id long, vector binary, code binary, correction double"))


def search(index: DataFrame, ids: np.ndarray, vectors: list[bytes], k: int = 5) -> tuple[DataFrame, Broadcast]:
    """The `k` nearest of each query (`ids`, packed `vectors`) among the vectors of its length:
    `query_id`, `vec_id`, `score`, at most k rows a query and task; and the broadcast to release."""
    sent = index.sparkSession.sparkContext.broadcast((ids, vectors))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[int, Nearest] | None = None
        for batch in batches:
            if near is None:
                q_ids, q_vectors = sent.value
                near = {
                    n: Nearest(QueryBlock(q_ids[at], _floats([q_vectors[i] for i in at]), rotation(n // 8)), k)
                    for n, at in _by_length(np.array([len(v) for v in q_vectors]))
                }
            row_ids, corr = batch.column("vec_id").to_numpy(), batch.column("correction").to_numpy()
            blobs, codes = batch.column("vector").to_pylist(), batch.column("code").to_pylist()
            for n, at in _by_length(np.array([len(v) for v in blobs], np.int64)):
                for i in range(0, len(at) if n in near else 0, CODE_BATCH):
                    part = at[i : i + CODE_BATCH]
                    words = np.frombuffer(b"".join([codes[p] for p in part]), np.uint64).reshape(len(part), -1)
                    near[n].add(row_ids[part], words, corr[part], _floats([blobs[p] for p in part]))
        for found in (near or {}).values():
            q, r = np.nonzero(np.isfinite(found.scores))
            yield pa.RecordBatch.from_arrays([pa.array(found.block.ids[q]), pa.array(found.ids[q, r]), pa.array(found.scores[q, r])], ["query_id", "vec_id", "score"])

    return index.select("vec_id", "vector", "code", "correction").mapInArrow(scan, "query_id long, vec_id long, score double"), sent


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(`query_id`, `rank` from 1, `vec_id`, `score`): the k nearest by cosine of every row
    that `is_query` (over `vec_id`) picks, among all rows but those of its own id.

    Rows that take no part (see `build_index`; those without an id among them) are neither
    queries nor found.  Vectors are compared with those of their own length.
    Ties go to the smaller vec_id.  Fewer than k candidates: all of them.  A
    repeated vec_id is one query (its vectors' smallest) and is found once per row.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    index = build_index(vectors, vec_id, embedding, scratch)
    picked = index.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    placed = global_index(picked, "vec_id", "_place", scratch)
    picked = scratch.stage(placed.withColumn("_block", F.floor(F.col("_place") / block)))
    blocks = picked.agg(F.coalesce(F.max("_block") + 1, F.lit(0))).first()[0]
    out = []
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for b in range(blocks):  # a block is bounded, and its broadcast is released before the next
        mine = picked.filter(F.col("_block") == b).orderBy("_place").toArrow()
        found, sent = search(index, mine.column("vec_id").to_numpy(), mine.column("vector").to_pylist(), k)
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        out.append(scratch.write(found.select("query_id", "rank", "vec_id", "score")))
        sent.unpersist()
    schema = "query_id long, rank int, vec_id long, score double"
    return spark.read.schema(schema).parquet(*out) if out else spark.createDataFrame([], schema)
