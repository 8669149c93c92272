"""Packing into optimal length buckets.

The lengths of all pieces (documents cut at `max_len` tokens) form a histogram of
at most max_len + 1 bins; dynamic programming over it picks the bucket
boundaries with the least padding; every bucket is then cut into batches of at
most `budget` tokens, padding included.

Only the histogram is gathered on the driver: its size is bounded by `max_len`,
not by the data.  Places inside a bucket are running counts over 2^bits seeded
parts (`common.prefix_sums`), so a bucket with most of the rows is spread.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import WORD, as_row, n_words, prefix_sums, uniform60


def optimal_boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Upper boundaries, ascending, of at most `n_buckets` buckets over the lengths of
    `histogram` (length: count) with the least sum of boundary - length.

    Exact: best[k][j] is the least padding of the j smallest lengths in k buckets.
    Of equal splits the one with the shortest last-but-one boundary is taken, and
    no more buckets than lengths.  No lengths: no boundaries.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    m = len(lengths)
    if not m:
        return []
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    c = np.concatenate([[0], np.cumsum(counts)])
    s = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = lengths * c[1:] - s[1:]  # one bucket
    best = np.concatenate([[0], best])
    cuts = []
    for k in range(2, min(n_buckets, m) + 1):
        new, cut = best.copy(), np.zeros(m + 1, dtype=np.int64)
        for j in range(k, m + 1):
            i = np.arange(k - 1, j)
            cost = best[k - 1 : j] + lengths[j - 1] * (c[j] - c[i]) - (s[j] - s[i])
            at = int(np.argmin(cost))
            new[j], cut[j] = cost[at], i[at]
        best = new
        cuts.append(cut)
    j, out = m, [int(lengths[m - 1])]
    for cut in reversed(cuts):
        j = int(cut[j])
        out.append(int(lengths[j - 1]))
    return out[::-1]


ADDED = ("piece", "n_pieces", "n_tokens", "bucket_len", "batch", "padding")


def pieces(docs: DataFrame, max_len: int, tokens: Column | None = None) -> DataFrame:
    """One row per piece of at most `max_len` tokens: the document's columns as `row`,
    `piece` from 0, `n_tokens`, `n_pieces` and `digest` (the text's MD5) of its document.  A
    document without tokens is one piece of length 0."""
    n = n_words(F.col("text")) if tokens is None else F.coalesce(tokens, F.lit(0)).cast("long")
    rows = as_row(docs, *ADDED, n=n, digest=F.md5("text"))
    last = F.greatest(F.lit(0), F.floor((F.col("n") - 1) / F.lit(max_len))).cast("int")
    out = rows.select("row", "n", "digest", (last + 1).alias("n_pieces"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    length = F.least(F.lit(max_len), F.col("n") - F.col("piece") * F.lit(max_len))
    return out.withColumn("n_tokens", length.cast("long")).drop("n")


def pack(docs: DataFrame, max_len: int = 4096, n_buckets: int = 12, budget: int = 65536, seed: str = "pack",
         tokens: Column | None = None, bits: int = 12) -> DataFrame:
    """Pack every document of `docs` (`doc_id`, `text`; other columns pass through).

    Returns a row per piece with `piece`, `n_pieces`, `n_tokens`, `bucket_len` (its bucket's
    boundary), `batch` (long, from 0 in each bucket) and `padding`.  A batch holds
    floor(budget / bucket_len) pieces, one at least; only the last batch of a bucket
    may hold fewer.  The order in a bucket is seeded by doc_id, piece and the text's MD5, so
    rows that share a doc_id (or have none) are spread by their texts.  Token
    counts are white-space words unless `tokens` gives a column.  Null or empty
    text is one piece of length 0; null doc_ids and repeated rows are pieces like
    any other; columns named as the added ones are replaced; no rows give none.
    """
    rows = pieces(docs, max_len, tokens)
    histogram = {r[0]: r[1] for r in rows.groupBy("n_tokens").count().collect()}  # at most max_len + 1 rows
    bounds = optimal_boundaries(histogram, n_buckets)
    bucket = F.lit(-1).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
    rows = rows.withColumns({"bucket_len": bucket, "one": F.lit(1).cast("long"), "u": uniform60(F.lit(seed), F.col("row.doc_id"), F.col("piece"), F.col("digest"))})
    rows = prefix_sums(rows, "bucket_len", "u", "one", "place", [F.col("row.doc_id"), F.col("piece"), F.col("digest")], bits)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_len"))))
    return rows.withColumns({
        "batch": F.floor(F.col("place") / per_batch).cast("long"),
        "padding": F.col("bucket_len") - F.col("n_tokens"),
    }).select("row.*", *ADDED)


def piece_text(rows: DataFrame, max_len: int) -> DataFrame:
    """Replace `text` by the piece's own part: its words with the white space after each
    (the first piece also has what stands before the first word), so that a document's
    pieces in turn are its text, byte for byte."""
    space = r"[\x20\x09-\x0D]*"
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD}{space})"), F.lit(1))
    cut = F.array_join(F.slice(runs, F.col("piece") * max_len + 1, max_len), "")
    lead = F.when(F.col("piece") == 0, F.regexp_extract("text", f"^({space})", 1)).otherwise("")
    return rows.withColumn("text", F.when(F.col("n_pieces") == 1, F.col("text")).otherwise(F.concat(lead, cut)))
