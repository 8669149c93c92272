"""Log-probabilities of whole documents under an n-gram model of a corpus, kept as an
Elias-Fano trie cut into shards.

The model interpolates pairs with words: p(w | v) = a(v, w) + g(v) p(w), with
a = c(v w) / (c(v) + PRIOR), g = PRIOR / (c(v) + PRIOR) and p(w) = (c(w) + 1) / (N + V + 1);
v is the word before, or the start of the document; g is 1 where v was never seen.  The
trie holds a as a code of 1 / `STEPS` of a decade.  Every count covers all training tokens.

The model grows with the corpus and nobody holds it whole.  Documents are coded in chunks
of about `CHUNK_TOKENS` tokens, each with its own word numbers.  A chunk asks the shards
that own its distinct words for their ids and counts, then those that own its distinct
pairs for their codes.  A question carries the chunk's training counts, so a shard first
sums them into its part of the model (for pairs: a trie in memory-mapped levels, see
`elias_fano`), then answers every chunk from it.  A word or pair however frequent is one
entry a chunk; successors of a context over `HOT` tokens are spread over all shards, which
is possible since c(v) comes with the word and not from the pairs.  Between the steps stand
tables in the shared folder.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revbridge.llm.common import Scratch
from revbridge.llm.elias_fano import Trie

PRIOR = 64.0
STEPS = 4096
#: Tokens coded together (a longer document is a chunk of its own).
CHUNK_TOKENS = 1_000_000
#: Entries of a shard, over all chunks, on average.
SHARD_ENTRIES = 1_000_000
#: A context of more tokens has its successors spread over all shards.
HOT = 500_000


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers >= 0 as byte planes, compressed."""
    out = []
    for a in arrays:
        width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
        planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
        body = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
        out.append(struct.pack("<QBQ", len(a), width, len(body)) + body)
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n, width, size = struct.unpack_from("<QBQ", blob, at)
        at += 17
        planes = np.frombuffer(pa.decompress(blob[at : at + size], n * width, codec="zstd", asbytes=True), np.uint8)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = planes.reshape(width, n).T
        out.append(whole.reshape(-1).view("<u8").astype(np.int64))
        at += size
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A spread-out hash of numbers."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


# -- chunks ---------------------------------------------------------------------------


def _coded(ids: list, held: list[bool], tokens: list[list[int]], words: list[bytes]) -> dict:
    """A chunk: its words, most frequent first, with training and other counts, and its tokens."""
    lengths = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate([np.array(t, np.int64) for t in tokens])
    every = np.bincount(flat, minlength=len(words))
    train = np.bincount(flat[~np.repeat(np.array(held, bool), lengths)], minlength=len(words))
    order = np.argsort(-every, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return {
        "ids": ids, "held": held, "lengths": pack(lengths), "tokens": pack(rank[flat]), "n_words": len(words), "n_tokens": len(flat),
        "words": pa.compress(b" ".join([words[i] for i in order]), codec="zstd", asbytes=True),
        "words_size": sum(map(len, words)) + len(words) - 1, "counts": pack(train[order], every[order] - train[order]),
    }


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def chunks(docs: DataFrame, doc_id: str, text: str, held_out: Column, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """The documents in chunks; their numbers hold for one run, so stage the result.  A-Z is lower-cased; a document's tokens are its words
    and one end, which the word list has as the empty word; null text has no words."""
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("held", T.ArrayType(T.BooleanType())),
        *[T.StructField(c, T.BinaryType()) for c in ("lengths", "tokens", "words", "counts")],
        *[T.StructField(c, T.LongType()) for c in ("words_size", "n_words", "n_tokens")],
    ])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        seq = 0
        arrow = None
        new: defaultdict = defaultdict()
        new.default_factory = new.__len__
        ids, held, tokens, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            return _rows([{"chunk": first + seq} | _coded(ids, held, tokens, list(new))], arrow)

        for batch in batches:
            if arrow is None:
                array = pa.list_(batch.schema.field("id").type)
                arrow = pa.schema([
                    ("chunk", pa.int64()), ("ids", array), ("held", pa.list_(pa.bool_())), *[(c, pa.binary()) for c in ("lengths", "tokens", "words", "counts")],
                    *[(c, pa.int64()) for c in ("words_size", "n_words", "n_tokens")],
                ])
            for i, t, h in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("held").to_pylist(), strict=True):
                found = list(map(new.__getitem__, (t.as_py() or b"").lower().split()))  # ASCII letters and white space only
                found.append(new[b""])
                ids.append(i)
                held.append(h)
                tokens.append(found)
                size += len(found)
                if size >= chunk_tokens:
                    yield flush()
                    seq, size, ids, held, tokens = seq + 1, 0, [], [], []
                    new.clear()
        if ids:
            yield flush()

    return rows.mapInArrow(code, schema)


# -- questions and answers --------------------------------------------------------------

ASK = "shard long, chunk long, asked binary"
ANSWER = "chunk long, shard long, answer binary, n_tokens long, n_distinct long"
_ASK = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("asked", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int64()), ("shard", pa.int64()), ("answer", pa.binary()), ("n_tokens", pa.int64()), ("n_distinct", pa.int64())])


def ask(table: DataFrame, questions: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(`shard`, `chunk`, `asked`): what each chunk asks of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                for shard, blob in questions(row):
                    yield _rows([{"shard": shard, "chunk": row["chunk"], "asked": blob}], _ASK)

    return table.mapInArrow(run, ASK)


def answered(table: DataFrame, answers: DataFrame) -> DataFrame:
    """Every chunk with `answers`, a map from shard to answer."""
    mine = answers.filter("chunk >= 0").groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("shard", "answer"))).alias("answers"))
    return table.join(mine, "chunk", "left")


def _by_shard(shard: np.ndarray, *then: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its entries ordered by `then`)."""
    order = np.lexsort((*reversed(then), shard))
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


def _word_list(row: dict) -> list[bytes]:
    return pa.decompress(row["words"], row["words_size"], codec="zstd", asbytes=True).split(b" ")


def _word_shards(words: list[bytes], shards: int) -> Iterator[tuple[int, np.ndarray]]:
    return _by_shard(np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words)))


def _sized(blob: bytes, *more: bytes) -> bytes:
    return struct.pack("<Q", len(blob)) + blob + b"".join(more)


def _ask_words(shards: int) -> Callable:
    def questions(row: dict) -> Iterator[tuple[int, bytes]]:
        words, (train, other) = _word_list(row), unpack(row["counts"])
        for shard, part in _word_shards(words, shards):
            yield shard, _sized(pa.compress(text := b" ".join([words[i] for i in part]), codec="zstd", asbytes=True), struct.pack("<Q", len(text)), pack(train[part], other[part]))

    return questions


def _words_answered(shards: int, hot: int) -> Callable[[pa.Table], pa.Table]:
    """Ids (1 + shard + shards * rank; 0 for a word unseen in training), counts and whether hot."""

    def run(table: pa.Table) -> pa.Table:
        shard, lists, numbers = table.column("shard")[0].as_py(), [], []
        place: defaultdict = defaultdict()
        place.default_factory = place.__len__
        for blob in table.column("asked").to_pylist():
            (size,) = struct.unpack_from("<Q", blob)
            (text,) = struct.unpack_from("<Q", blob, 8 + size)
            words = pa.decompress(blob[8 : 8 + size], text, codec="zstd", asbytes=True).split(b" ")
            lists.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
            numbers.append(unpack(blob[16 + size :]))
        train, every = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for at, (t, o) in zip(lists, numbers, strict=True):
            train[at] += t
            every[at] += t + o
        order = np.argsort(-every, kind="stable")
        number = np.zeros(len(place), np.int64)
        number[order] = 1 + shard + shards * np.arange(len(place))
        number[train == 0] = 0
        rows = [{"chunk": c, "shard": shard, "answer": pack(number[at], train[at], (every[at] > hot).astype(np.int64))} for c, at in zip(table.column("chunk").to_pylist(), lists, strict=True)]
        rows.append({"chunk": -1, "shard": shard, "n_tokens": int(train.sum()), "n_distinct": int((train > 0).sum())})
        return pa.Table.from_pylist(rows, _ANSWER)

    return run


def _numbered(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks with the ids, counts and hot marks of their words in place of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                row = one.select(["words", "words_size", "answers"]).to_pylist()[0]
                words, answers = _word_list(row), dict(row["answers"])
                number, count, hot = (np.zeros(len(words), np.int64) for _ in range(3))
                for shard, part in _word_shards(words, shards):
                    number[part], count[part], hot[part] = unpack(answers[shard])
                end = words.index(b"")
                own = [pa.array([pack(number, count, hot)], pa.binary()), pa.array([end], pa.int64())]
                yield pa.RecordBatch.from_arrays([*[one.column(c) for c in ("chunk", "ids", "held", "lengths", "tokens")], *own], ["chunk", "ids", "held", "lengths", "tokens", "vocabulary", "end"])

    return run


class Pairs:
    """The distinct (context, word) pairs of a chunk whose words training has seen."""

    def __init__(self, row: dict, shards: int):
        self.lengths, = unpack(row["lengths"])
        self.tokens, = unpack(row["tokens"])
        number, self.count, hot = unpack(row["vocabulary"])
        start, end = len(number), row["end"]  # the start of a document has the number 0 and as many tokens as the end
        number, total, hot = np.append(np.where(number > 0, number, -1), 0), np.append(self.count, self.count[end]), np.append(hot, hot[end])
        self.starts = np.cumsum(self.lengths) - self.lengths
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = start
        self.total = np.where(number[before] >= 0, total[before], 0)
        self.asked = np.flatnonzero((self.total > 0) & (number[self.tokens] >= 0))
        width = start + 1
        pairs, self.inverse = np.unique(before[self.asked] * width + self.tokens[self.asked], return_inverse=True)
        train = ~np.repeat(np.array(row["held"], bool), self.lengths)
        self.n = np.bincount(self.inverse, weights=train[self.asked], minlength=len(pairs)).astype(np.int64)
        self.context, self.word = number[pairs // width], number[pairs % width]
        self.context_total = total[pairs // width]
        spread = np.where(hot[pairs // width] > 0, self.word + 1, 0)
        self.shard = ((_mixed(self.context + 1) ^ _mixed(spread)) % np.uint64(shards)).astype(np.int64)

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        return _by_shard(self.shard, self.context, self.word)


def _ask_pairs(shards: int) -> Callable:
    def questions(row: dict) -> Iterator[tuple[int, bytes]]:
        pairs = Pairs(row, shards)
        for shard, part in pairs.parts():
            step = np.diff(pairs.context[part], prepend=-1)
            yield shard, pack(step, pairs.word[part], pairs.n[part], pairs.context_total[part][step > 0])

    return questions


def codes_of(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + the smoothed share n / (total + PRIOR) in steps of 1 / STEPS of a decade."""
    return (1 + np.minimum(65534, np.floor(-np.log10(n / (total + PRIOR)) * STEPS + 0.5))).astype(np.uint16)


def share_of(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEPS), 0.0)


def build_trie(context: np.ndarray, word: np.ndarray, n: np.ndarray, total: np.ndarray) -> Trie:
    """The trie of pairs seen in training, from their counts in any order, repeated or not."""
    seen = np.flatnonzero(n > 0)
    order = seen[np.lexsort((word[seen], context[seen]))]
    context, word = context[order], word[order]
    first = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])])) if len(order) else order
    counts = np.add.reduceat(n[order], first) if len(order) else order
    return Trie.build(context[first], word[first], codes_of(counts, total[order][first]))


def _pairs_answered(table: pa.Table) -> pa.Table:
    asked = []
    for blob in table.column("asked").to_pylist():
        step, word, n, totals = unpack(blob)
        asked.append((np.cumsum(step) - 1, word, n, totals[np.cumsum(step > 0) - 1]))
    trie = build_trie(*[np.concatenate(parts) for parts in zip(*asked, strict=True)]).mapped()
    shard = table.column("shard")[0].as_py()
    rows = [{"chunk": c, "shard": shard, "answer": pack(trie.lookup(context, word).astype(np.int64))} for c, (context, word, _, _) in zip(table.column("chunk").to_pylist(), asked, strict=True)]
    return pa.Table.from_pylist(rows, _ANSWER)


def _scored(shards: int, n_tokens: int, n_distinct: int, id_type: T.DataType) -> tuple[Callable, T.StructType]:
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                row = one.select(["held", "lengths", "tokens", "vocabulary", "end", "answers"]).to_pylist()[0]
                pairs, answers = Pairs(row, shards), dict(row["answers"] or [])
                found = np.zeros(len(pairs.context), np.int64)
                for shard, part in pairs.parts():
                    found[part], = unpack(answers[shard])
                share = np.zeros(len(pairs.tokens))
                share[pairs.asked] = share_of(found)[pairs.inverse]
                alone = (pairs.count + 1) / (n_tokens + n_distinct + 1)  # of each word of the chunk
                p = share + np.where(pairs.total > 0, PRIOR / (pairs.total + PRIOR), 1.0) * alone[pairs.tokens]
                sums = [np.add.reduceat(x.astype(np.longdouble), pairs.starts).astype(np.float64) for x in (np.log10(alone)[pairs.tokens], np.log10(p))]
                known = np.add.reduceat((pairs.count > 0).astype(np.int64)[pairs.tokens], pairs.starts)
                ids = one.column("ids").flatten()
                yield pa.RecordBatch.from_arrays([ids, pa.array(row["held"], pa.bool_()), *map(pa.array, (pairs.lengths, known, *sums))], ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run, schema


def score_documents(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None,
    chunk_tokens: int = CHUNK_TOKENS, shard_entries: int = SHARD_ENTRIES, hot: int = HOT,
) -> DataFrame:
    """One row per document: `id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`,
    `base_score` (log10 probability by words alone) and `score` (by the model).

    The model is learned from the rows for which `held_out` is not true and scores all.
    Null and empty texts are the end alone.  Repeated rows count as often as they stand.
    With nothing to learn from, every token is unknown.  No rows: none.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    path = scratch.write(chunks(docs, doc_id, text, held_out, chunk_tokens))
    coded = scratch.read(path)
    entries, tokens = coded.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    shards = max(1, -(-(entries or 0) // shard_entries))
    asked = ask(coded.select("chunk", "words", "words_size", "counts"), _ask_words(shards))
    words = scratch.stage(asked.groupBy("shard").applyInArrow(_words_answered(shards, hot), ANSWER))
    n_tokens, n_distinct = words.filter("chunk < 0").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_distinct"), F.lit(0))).first()

    fields = T.StructType([f for f in coded.schema.fields if f.name in ("chunk", "ids", "held", "lengths", "tokens")])
    fields = fields.add("vocabulary", T.BinaryType()).add("end", T.LongType())
    numbered = scratch.stage(answered(coded.drop("counts", "n_words", "n_tokens"), words).mapInArrow(_numbered(shards), fields))
    scratch.drop(path)

    shards = max(1, -(-(tokens or 0) // shard_entries))
    pairs = ask(numbered, _ask_pairs(shards)).groupBy("shard").applyInArrow(_pairs_answered, ANSWER)
    run, schema = _scored(shards, n_tokens, n_distinct, docs.schema[doc_id].dataType)
    return answered(numbered, pairs).mapInArrow(run, schema).withColumn("train_tokens", F.lit(n_tokens).cast("long"))
