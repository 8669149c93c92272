"""Hard negatives by threshold joins in the manner of L2AP.

Scores are inner products of integer vectors.  What is wanted of an anchor are windows: the
best `k` rows with low <= score <= high, of its own label (its positives) or of others (the
negatives of each positive).  Anchors go out in blocks of `ANCHOR_BLOCK`; every task joins
its rows with a block, batch by batch:

* Dimensions are ordered by weight.  For a threshold t of an anchor q, a row x whose tail
  satisfies |x_tail| |q| < t need not be found by that tail: the inverted index of a batch
  lists x only in the dimensions before it.
* Partial scores are accumulated list by list.  After each, a pair whose partial score plus
  |q_rest| |x_rest| is below t is out, and a row with no pair left leaves the lists.
* What stays is scored exactly with the tail and enters the windows it fits.
* t begins near the most that a window can hold and is lowered, the lists growing with it,
  until the windows are full above t or t reaches their floor.  Full windows raise the
  floor, so that later batches begin high.

Scores are exact: sums stay below 2^53 as doubles, or are made of 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revbridge.llm.common import Scratch, global_index

#: Anchors sent out at a time, and rows joined with them at a time.
ANCHOR_BLOCK, ROW_BATCH = 1024, 1024
#: Dimensions of one posting list.
LIST_DIMS = 8
#: Steps by which a threshold falls from the top of the windows to their floor.
ROUNDS = 4
#: Rows of a squared norm beyond this take no part: their scores might not fit a long.
MOST_NORM = float(1 << 62)
NONE = np.iinfo(np.int64).min
FAR = np.iinfo(np.int64).max


class Windows:
    """Per window the best k (score, smaller id first) rows so far; windows of an anchor are
    consecutive, `anchor` is ascending."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, anchors: int):
        self.anchor, self.low, self.high, self.k = anchor, low, high, k
        self.first = np.searchsorted(anchor, np.arange(anchors + 1))
        self.scores = np.full((len(anchor), k), NONE, np.int64)
        self.ids = np.full((len(anchor), k), FAR, np.int64)

    def floor(self) -> np.ndarray:
        """Per anchor the least score that still matters (FAR: none does)."""
        own = np.maximum(self.low, self.scores[:, -1])
        out = np.full(len(self.first) - 1, FAR, np.int64)
        np.minimum.at(out, self.anchor, np.where(self.low <= self.high, own, FAR))
        return out

    def top(self) -> np.ndarray:
        out = np.full(len(self.first) - 1, NONE, np.int64)
        np.maximum.at(out, self.anchor, self.high)
        return out

    def add(self, anchor: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        n = self.first[anchor + 1] - self.first[anchor]
        pair = np.repeat(np.arange(len(anchor)), n)
        window = np.repeat(self.first[anchor], n) + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        s = scores[pair]
        fits = (s >= np.maximum(self.low[window], self.scores[window, -1])) & (s <= self.high[window])
        window, s, found = window[fits], s[fits], ids[pair[fits]]
        touched = np.unique(window)
        if not len(touched):
            return
        rows = np.concatenate([np.repeat(touched, self.k), window])
        every_s, every_id = np.concatenate([self.scores[touched].ravel(), s]), np.concatenate([self.ids[touched].ravel(), found])
        order = np.lexsort((every_id, -every_s.astype(np.float64), rows)) if abs(every_s[every_s != NONE]).max(initial=0) < 1 << 53 else np.lexsort((every_id, ~every_s, rows))
        starts = np.searchsorted(rows[order], touched)
        best = order[starts[:, None] + np.arange(self.k)]
        self.scores[touched], self.ids[touched] = every_s[best], every_id[best]


def tails(x: np.ndarray, lists: int) -> np.ndarray:
    """(rows, lists + 1): the norm of a row from each list's first dimension on."""
    squares = np.square(x.astype(np.float64)).reshape(len(x), lists, -1).sum(axis=2)
    sums = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([sums, np.zeros((len(x), 1))], axis=1))


class Join:
    """Anchors against batches of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: Windows, same_label: bool):
        self.ids, self.labels, self.windows, self.same = ids, labels, windows, same_label
        weight = np.square(vectors.astype(np.float64)).sum(axis=0)
        self.order = np.argsort(-weight, kind="stable")
        self.vectors = vectors
        self.accumulated = self.scored = 0

    def _laid_out(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Anchors and rows, dimensions ordered and filled up with zeros."""
        dims = max(self.vectors.shape[1], rows.shape[1])
        lists = max(1, -(-dims // LIST_DIMS))
        q, x = np.zeros((len(self.ids), lists * LIST_DIMS), np.int64), np.zeros((len(rows), lists * LIST_DIMS), np.int64)
        order = np.concatenate([self.order, np.arange(len(self.order), dims)])
        q[:, : self.vectors.shape[1]] = self.vectors[:, self.order]
        x[:, :dims] = np.pad(rows, ((0, 0), (0, dims - rows.shape[1])))[:, order]
        return q, x, lists

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        q, x, lists = self._laid_out(rows)
        q_tail, x_tail = tails(q, lists), tails(x, lists)
        q_norm, x_norm = q_tail[:, 0], x_tail[:, 0]
        if q_norm.max(initial=0) * x_norm.max(initial=0) < 1 << 53:
            q, x = q.astype(np.float64), x.astype(np.float64)
        open_ = (self.labels[:, None] == labels[None, :]) == self.same
        open_ &= self.ids[:, None] != ids[None, :]
        partial = np.zeros(open_.shape, q.dtype)
        done = np.zeros(len(ids), np.int64)  # lists a row is accumulated over
        most = x_norm.max(initial=0)
        top = np.minimum(self.windows.top().astype(np.float64), q_norm * most + 1)
        floor = self.windows.floor()
        bottom = np.maximum(floor.astype(np.float64), -q_norm * most - 1)
        slack = 1 + 1e-9 * q_norm * most
        active = np.flatnonzero((floor != FAR) & (top + slack >= bottom))
        for step in range(1, ROUNDS + 1):
            if not len(active):
                return
            now = np.maximum(self.windows.floor()[active].astype(np.float64), bottom[active])
            t = np.maximum(now, top[active] - (top - bottom)[active] * step / ROUNDS)
            t = now if step == ROUNDS else t
            self._round(active, t - slack[active], ids, q, x, q_tail, x_tail, lists, open_, partial, done)
            full = self.windows.floor()[active].astype(np.float64) >= t  # nothing below t matters any more
            active = active[~full & (t > now)] if step < ROUNDS else active[:0]

    def _round(self, active, t, ids, q, x, q_tail, x_tail, lists, open_, partial, done) -> None:
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.nan_to_num(t / q_tail[active, 0], nan=-np.inf).min()
        need = (x_tail >= reach).sum(axis=1)  # tails shrink: the lists before the first tail that is covered
        need = np.minimum(need, lists)
        alive = np.arange(len(ids))
        out_of = np.zeros((len(active), len(ids)), bool)
        for g in range(lists):
            posting = alive[(need[alive] > g) & (done[alive] <= g)]
            if len(posting):
                d = slice(g * LIST_DIMS, (g + 1) * LIST_DIMS)
                partial[:, posting] += q[:, d] @ x[posting, d].T
                done[posting] = g + 1
                self.accumulated += len(posting)
            rest = done[alive]
            best = partial[np.ix_(active, alive)] + q_tail[np.ix_(active, np.arange(lists + 1))][:, rest] * x_tail[alive, rest]
            out_of[:, alive] |= best < t[:, None]
            alive = alive[(open_[np.ix_(active, alive)] & ~out_of[:, alive]).any(axis=0)]
            if not len(alive):
                return
        a, c = np.nonzero(open_[np.ix_(active, alive)] & ~out_of[:, alive])
        a, c = active[a], alive[c]
        open_[a, c] = False
        self.scored += len(a)
        for i in range(0, len(a), 1 << 16):
            pa_, pc = a[i : i + (1 << 16)], c[i : i + (1 << 16)]
            score = partial[pa_, pc].astype(np.int64)
            for g in range(lists):  # the tail that the index leaves out
                late = np.flatnonzero(done[pc] <= g)
                if len(late):
                    d = slice(g * LIST_DIMS, (g + 1) * LIST_DIMS)
                    score[late] += (q[pa_[late], d] * x[pc[late], d]).sum(axis=1).astype(np.int64)
            self.windows.add(pa_, ids[pc], score)


def _matrix(blobs: list[bytes]) -> np.ndarray:
    """Rows of packed 64-bit integers, the shorter ones filled up with zeros."""
    size = max((len(b) for b in blobs), default=0)
    return np.frombuffer(b"".join(b.ljust(size, b"\0") for b in blobs), np.int64).reshape(len(blobs), -1)


def prepare(vectors: DataFrame, label: Column, scale: float, vec_id: str, embedding: str) -> DataFrame:
    """(`vec_id`, `label`, `vector` as packed integers floor(scale x)) of the rows that take part."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            ends = lists.offsets.to_numpy()
            flat = np.floor(scale * lists.values.to_numpy(zero_copy_only=False).astype(np.float64))
            parts = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            with np.errstate(over="ignore"):
                good = [float(np.square(p).sum()) < MOST_NORM for p in parts]
            blobs = [p.astype(np.int64).tobytes() if g else None for p, g in zip(parts, good, strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(blobs, pa.binary())], ["vec_id", "label", "vector"])
            yield out.filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(whole, "vec_id long, label long, vector binary")


def scan(index: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: list[bytes], windows: tuple, k: int, same_label: bool) -> tuple[DataFrame, object]:
    """(`window`, `vec_id`, `score`: at most k rows a window and task; the broadcast to release)."""
    sent = index.sparkSession.sparkContext.broadcast((ids, labels, vectors, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = None
        for batch in batches:
            if join is None:
                own_ids, own_labels, own_vectors, (anchor, low, high) = sent.value
                join = Join(own_ids, own_labels, _matrix(own_vectors), Windows(anchor, low, high, k, len(own_ids)), same_label)
            for i in range(0, batch.num_rows, ROW_BATCH):
                part = batch.slice(i, ROW_BATCH)
                join.add(part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("vector").to_pylist()))
        if join is not None:
            w, r = np.nonzero(join.windows.scores != NONE)
            found = join.windows
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(found.ids[w, r]), pa.array(found.scores[w, r])], ["window", "vec_id", "score"])

    return index.mapInArrow(run, "window long, vec_id long, score long"), sent


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _part_of(value: int, share: tuple[int, int], up: bool) -> int:
    n, d = share
    return -(-value * n // d) if up else value * n // d


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100),
    scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding", scratch: Scratch | None = None, block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(`anchor_id`, `positive_id`, `rank` from 1, `negative_id`, `positive_score`,
    `negative_score`): for every anchor (`is_anchor` over `vec_id`) and each of its
    `positives` best rows of its label, the best `negatives` rows of other labels whose score
    is from `low` to `high` (numerator, denominator) of the positive's.  Higher scores come
    first, ties by smaller vec_id.

    Rows with a null id, label or vector, a null or non-finite component, or a squared norm
    (of integers) of 2^62 and more take no part.  A shorter vector is zero beyond its end.
    Several rows of one id: the anchor is the one of least label, then vector; they are never
    each other's partners; to other anchors each is a row of its own.  No anchors, no
    positives or no row in a window: no rows.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    index = scratch.stage(prepare(vectors, F.col("label") if label is None else label, scale, vec_id, embedding))
    own = index.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    placed = global_index(own.select("vec_id", "row.label", "row.vector"), "vec_id", "_place", scratch)
    placed = scratch.stage(placed.withColumn("_block", F.floor(F.col("_place") / block)))
    blocks = placed.agg(F.coalesce(F.max("_block") + 1, F.lit(0))).first()[0]
    out = []
    for b in range(blocks):  # a block is bounded; its broadcasts are released before the next
        rows = placed.filter(F.col("_block") == b).orderBy("_place").toArrow()
        ids, labels, mine_ = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), rows.column("vector").to_pylist()
        every = np.arange(len(ids))
        found, sent = scan(index, ids, labels, mine_, (every, np.full(len(ids), NONE + 1), np.full(len(ids), FAR)), positives, True)
        best = _ranked(found, positives).orderBy("window", "rank").toArrow()  # at most `positives` rows an anchor
        sent.unpersist()
        anchor, score = best.column("window").to_numpy(), best.column("score").to_pylist()
        bounds = [np.array([_part_of(s, share, up) for s in score], np.int64) for share, up in ((low, True), (high, False))]
        found, sent = scan(index, ids, labels, mine_, (anchor, *bounds), negatives, False)
        of = scratch.spark.createDataFrame(pa.table({
            "window": pa.array(np.arange(len(anchor))), "anchor_id": pa.array(ids[anchor]), "positive_id": best.column("vec_id"), "positive_score": best.column("score"),
        }))
        ranked = _ranked(found, negatives).join(F.broadcast(of), "window")  # at most `positives` rows an anchor of the block
        out.append(scratch.write(ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
        sent.unpersist()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return scratch.spark.read.schema(schema).parquet(*out) if out else scratch.spark.createDataFrame([], schema)
