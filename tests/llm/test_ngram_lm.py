"""Elias-Fano levels, the trie and the model's scores against plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revbridge.llm import ngram_lm
from revbridge.llm.elias_fano import EliasFano, Trie

from .brute import lower, words

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("n,top", [(0, 10), (1, 1), (1, 10**12), (5, 5), (1000, 10), (1000, 10**6), (3000, 10**14), (64, 64), (129, 100000)])
def test_sequences(n, top):
    rng = np.random.default_rng(n + top % 97)
    values = np.sort(rng.integers(0, top, n))
    seq = EliasFano.of(values)
    assert (seq.get(np.arange(n)) == values).all()
    asked = np.unique(np.concatenate([values, values + 1, rng.integers(0, top + 5, 200), [0, 2 * top + 100]]))
    assert (seq.find(asked) == np.searchsorted(values, asked)).all()


def test_trie_finds_its_pairs_and_no_others():
    rng = np.random.default_rng(4)
    pairs = np.unique(np.stack([rng.integers(0, 300, 4000), rng.zipf(1.3, 4000) % 5000], 1), axis=0)
    trie = Trie.build(pairs[:, 0], pairs[:, 1], (np.arange(len(pairs)) % 60000 + 1).astype(np.uint16)).mapped()
    assert (trie.find(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    have = set(map(tuple, pairs.tolist()))
    other = np.stack([rng.integers(0, 310, 5000), rng.integers(0, 6000, 5000)], 1)
    place = trie.find(other[:, 0], other[:, 1])
    assert all((p >= 0) == (tuple(o) in have) for p, o in zip(place.tolist(), other.tolist()))
    none = np.zeros(0, np.int64)
    assert Trie.build(none, none, none.astype(np.uint16)).mapped().lookup(np.array([1]), np.array([2])).tolist() == [0]


def test_packed_arrays():
    arrays = [np.array([0, 255, 256, 70000, 2**40]), np.zeros(0, np.int64), np.zeros(5, np.int64)]
    assert [a.tolist() for a in ngram_lm.unpack(ngram_lm.pack(*arrays))] == [a.tolist() for a in arrays]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    tokens = [words(lower(t)) + [""] for _, t in rows]
    train = [t for t, (d, _) in zip(tokens, rows) if not is_held(d)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([None, *t], t))
    total = {**{w: c for w, c in one.items() if w}, None: len(train)}
    n, v = sum(one.values()), len(one)
    out = []
    for (d, _), t in zip(rows, tokens):
        alone = [(one[w] + 1) / (n + v + 1) for w in t]
        score = []
        for a, pair in zip(alone, zip([None, *t], t)):
            ctx, share = total.get(pair[0], 0), 0.0
            if two[pair]:
                share = 10 ** (-math.floor(-math.log10(two[pair] / (ctx + ngram_lm.PRIOR)) * ngram_lm.STEPS + 0.5) / ngram_lm.STEPS)
            score.append(math.log10(share + (ngram_lm.PRIOR / (ctx + ngram_lm.PRIOR) if ctx else 1) * a))
        out.append((d, is_held(d), len(t), sum(w in one for w in t), n, f"{math.fsum(map(math.log10, alone)):.8g}", f"{math.fsum(score):.8g}"))
    return sorted(out, key=repr)


def result(df, **kw):
    out = ngram_lm.score_documents(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, **kw)
    rows = out.select("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    return sorted(((*r[:5], f"{r[5]:.8g}", f"{r[6]:.8g}") for r in rows), key=repr)


def corpus():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "The", "a", "cat", "É", f"w{rng.randrange(200)}"]) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(None, None), (None, "the cat"), (3, ""), (3, " \t\n\x0b"), (4, "the the the " * 3000), (4, "x" * 100000), (5, "no break the cat"), (6, "the cat"), (6, "the cat")]
    return rows


def test_scores(spark):
    rows = corpus()
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_scores_over_many_chunks_and_shards(spark):
    """Small chunks and shards, every frequent context spread: the same scores."""
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    df = df.withColumns({n: F.lit("x") for n in "id chunk ids held words shard answers n_tokens score".split()})
    assert result(df, chunk_tokens=60, shard_entries=50, hot=10) == brute(rows)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if is_held(i))
    rows = [(held, "a b c"), (held, None)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_probabilities_sum_to_one():
    n, total, v = np.array([3, 1, 6]), 10, 50
    share = ngram_lm.share_of(ngram_lm.codes_of(n, np.full(3, total))).sum()
    assert abs(share + ngram_lm.PRIOR / (total + ngram_lm.PRIOR) - 1) < 1e-3 and v


def test_held_out_text_is_better_explained_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = ngram_lm.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).filter("held_out")
    base, score = out.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base
