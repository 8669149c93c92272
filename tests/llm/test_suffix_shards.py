"""What one key or one passage may bring into a single task of suffix dedup."""

import random
from collections import Counter

from pyspark.sql import functions as F

from revbridge.llm import suffix_dedup

from . import brute

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def letters(rnd, n):
    return "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))


def test_repeated_rows_share_their_intervals_and_snippets(spark, monkeypatch):
    rnd = random.Random(5)
    passage = letters(rnd, 900)
    text = letters(rnd, 300) + passage + letters(rnd, 300)
    rows = [(1, text)] * 60 + [(2, "q" + passage[50:700] + "q"), (None, "r" + passage[100:]), (None, "r" + passage[100:])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = {}
    snippets, join = suffix_dedup._snippets, type(frame).join

    def counted_snippets(packed, asked, width):
        out = snippets(packed, asked, width)
        seen["snippets"] = out.groupBy("k1", "k2", "first", "snippet").count().agg(F.max("count")).first()[0]
        return out

    def counted_join(self, other, *args, **kwargs):
        if "gone" in other.columns:
            seen["gone"] = other.select(F.max(F.size("gone") - F.size(F.array_distinct("gone")))).first()[0]
        return join(self, other, *args, **kwargs)

    monkeypatch.setattr(suffix_dedup, "_snippets", counted_snippets)
    monkeypatch.setattr(type(frame), "join", counted_join)
    got = Counter(tuple(r[c] for c in COLUMNS) for r in suffix_dedup.remove_repeats(frame).collect())
    assert got == Counter(brute.repeats(rows))
    assert seen == {"snippets": 1, "gone": 0}


def hot_passage(rnd, n, passage):
    return [(i, letters(rnd, 150 + i % 40) + passage + letters(rnd, 120)) for i in range(n)]


def test_a_passage_of_many_documents_fills_no_shard(spark, monkeypatch):
    """The largest part that is sorted by one task stays below its bound however many documents
    hold the passage; blocks across its edges are settled by counting windows."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1 << 14)
    monkeypatch.setattr(suffix_dedup, "HOT_USES", 20)
    settle = suffix_dedup._settled_blocks
    seen = []

    def sized(blocks, width, scratch, most):
        equal, open_blocks = settle(blocks, width, scratch, most)
        parts = open_blocks.groupBy("shard").agg(F.sum(F.octet_length("snippet")).alias("n")).agg(F.max("n")).first()[0] or 0
        all_parts = blocks.groupBy("shard").agg(F.sum(F.octet_length("snippet")).alias("n")).agg(F.max("n")).first()[0]
        seen.append((parts, all_parts, most))
        return equal, open_blocks

    monkeypatch.setattr(suffix_dedup, "_settled_blocks", sized)
    for n in (60, 160):
        rnd = random.Random(9)
        passage = letters(rnd, 600)
        rows = hot_passage(rnd, n, passage) + [(900, "q" + passage[:260] + "q" + passage[200:]), (901, None), (902, passage * 2)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = Counter(tuple(r[c] for c in COLUMNS) for r in suffix_dedup.remove_repeats(frame).collect())
        assert got == Counter(brute.repeats(rows))
    assert all(parts <= most for parts, _, most in seen)
    assert seen[1][1] > 2 * seen[0][1] > 0  # without the count it would grow with the documents
