"""Quality rules: base measures of each text, and cross-document line frequency.

Normalised lines are hashed, and the distinct documents that carry a line are
counted per host.  A line above the limits is removed from the host's documents
wherever it stands; a document that loses too much is depleted and rejected.

A line that over `site_share` of all documents of its host carry, copies counted
each, is boilerplate of the site whatever stands around it.  Below that share copies
of one document must not make its lines look like boilerplate, or a clean text would
go together with all its copies: there documents count once per text, and a line
must also stand in different surroundings (`min_spread`): a navigation
line does, a sentence of a much-copied text does not.  Surroundings are the two
neighbour lines, or, as blank lines and the lines of one menu always have the same
neighbours, what is left of the document without any frequent line.  Near copies
differ in little, so only a rest that would not be depleted counts.

The measures of a text need only that text; they are taken in Arrow batches.
Line counts are map-side combined aggregates over hashes, so neither a host with
a third of all documents nor a line that they all carry is held by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch, as_row, group_key, n_words, normal_line, row_key

#: Words of a window whose repeats count, and the base limits.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Tasks over which the rows of one line of a host are dealt.
SALT = 16
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """A line is above the limits of its host if more than `min_documents` distinct
    documents (rows of one doc_id and text are one) and more than `site_share` of the host's
    carry it; or if more than `min_documents` distinct texts and more than `max_share` of the host's texts carry it, and the
    distinct pairs of neighbour lines it stands between, or the distinct rests of those
    texts (their lines not above the first two limits, where the rest is not
    depleted), are at least `min_spread` of those texts.  A document is depleted if more than `max_removed` of its words
    go, or fewer than `min_left` words are left."""

    min_documents: int = 8
    max_share: float = 0.002
    site_share: float = 0.6
    min_spread: float = 0.5
    max_removed: float = 0.7
    min_left: int = 3


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of `window` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    rank, below = codes, len(ids)
    for k in range(1, window):  # rank[i] is one number for the k + 1 words from i on
        if below > 2**62 // len(ids):
            rank, below = np.unique(rank, return_inverse=True)[1], len(words)
        rank = rank[: len(words) - k] * len(ids) + codes[k:]
        below *= len(ids)
    _, place, count = np.unique(rank, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[place] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[at] += 1
    edges[at + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = sum(map(len, words))
    chars -= len(raw) - len(raw.translate(None, _CONTINUATION))  # code points, not bytes
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += bool(line.split())
        else:
            seen.add(line)
    return len(words), chars, symbols, dup, repeated_words(words)


def text_measures(docs: DataFrame, *keep: str) -> DataFrame:
    """`keep` columns and the five measures (long) of the column `text`."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"{n} long" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(t.as_py()) for t in batch.column(len(keep))]
            out = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], [*keep, *names])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(fields))


def keyed(docs: DataFrame, host: str) -> DataFrame:
    """`k1`, `k2` (the digest of doc_id, text and host), `doc_id`, `text`, `host`."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), docs[host].alias("host"))
    return rows.select(*row_key(F.col("doc_id"), F.col("text"), F.col("host")), "doc_id", "text", group_key(F.col("host")).alias("host"))


def _halves(h) -> tuple:
    """A hash as two numbers whose sums over a document's lines do not overflow."""
    return F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))


def _depleted(words, removed, limits: Limits):
    return (removed > words * F.lit(limits.max_removed)) | (words - removed < limits.min_left)


def host_lines(rows: DataFrame) -> DataFrame:
    """One row per line with a word of `keyed` rows: `k1`, `k2`, `host` and `text_hash` (hashes), its place
    `at`, the line's hash `h`, `around` (hash of its neighbours) and its words `n`; and of all such lines of
    the document the `words` and the sums `high` and `low` of their hashes' halves."""
    rows = rows.select(
        "k1", "k2", F.xxhash64("host").alias("host"), F.xxhash64("text").alias("text_hash"),
        F.transform(F.split("text", "\n"), normal_line).alias("lines"),
    ).withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
    beside = lambda i: F.coalesce(F.try_element_at("hashes", i), F.lit(0))
    line = F.transform("lines", lambda x, i: F.struct(
        i.alias("at"), F.xxhash64(x).alias("h"), n_words(x).alias("n"),
        F.xxhash64(F.when(i > 0, beside(F.greatest(i, F.lit(1)))).otherwise(0), beside(i + 2)).alias("around"),
    ))
    rows = rows.select("k1", "k2", "host", "text_hash", F.filter(line, lambda x: x["n"] > 0).alias("line"))
    total = lambda value: F.aggregate("line", F.lit(0).cast("long"), lambda acc, x: acc + value(x))
    rows = rows.withColumns({
        "words": total(lambda x: x["n"]), "high": total(lambda x: _halves(x["h"])[0]), "low": total(lambda x: _halves(x["h"])[1]),
    })
    # the outer form: for the plain one a filter of `line` is inferred and pushed down, which makes the hashes anew for each line
    rows = rows.select("k1", "k2", "host", "text_hash", "words", "high", "low", F.explode_outer("line").alias("line"))
    return rows.select("k1", "k2", "host", "text_hash", "words", "high", "low", "line.*").filter("n > 0")


def distinct_rests(frequent: DataFrame, limits: Limits) -> DataFrame:
    """(`host`, `h`, `rests`) of `frequent`, all lines of their documents above the counts: the distinct
    rests that documents with the line have without such lines, where they are not depleted."""
    text = ["host", "text_hash", "words", "high", "low"]
    once = frequent.groupBy(*text, "at", "h", "n").agg(F.lit(1).alias("one"))  # copies count once
    high, low = _halves(F.col("h"))
    rest = once.groupBy(*text).agg(
        F.sum("n").alias("removed"), F.sum(high).alias("high_removed"), F.sum(low).alias("low_removed"), F.collect_set("h").alias("lines"),
    ).filter(~_depleted(F.col("words"), F.col("removed"), limits))
    rest = rest.select("host", F.xxhash64(F.col("high") - F.col("high_removed"), F.col("low") - F.col("low_removed")).alias("rest"), F.explode("lines").alias("h"))
    rest = rest.groupBy("host", "h", "rest").agg(F.lit(1).alias("one"))
    return rest.groupBy("host", "h").agg(F.count("*").alias("rests"))


def among(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `lines` whose (`host`, `h`) is one of `keys`; a hot line's rows are dealt over SALT tasks."""
    salted = keys.select("host", "h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("_s"))
    return lines.withColumn("_s", F.pmod("k1", F.lit(SALT))).join(salted, ["host", "h", "_s"], "left_semi").drop("_s")


def lines_above(lines: DataFrame, rows: DataFrame, limits: Limits, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(`host`, `h`) of the lines above the limits of their host, and the rows of `lines` they are among."""
    hosts = rows.select(F.xxhash64("host").alias("host"), F.xxhash64("text").alias("t"), "k1", "k2").distinct()
    hosts = hosts.groupBy("host", "t").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("all"), F.sum("n").alias("all_documents"))
    # a cheap count first: few lines are carried often enough to look closer
    often = lines.groupBy("host", "h").agg(F.count("*").alias("rows")).filter(F.col("rows") > limits.min_documents)
    copies = among(lines, often).groupBy("host", "h", "text_hash", "k1", "k2").agg(F.lit(1).alias("one"))
    texts = copies.groupBy("host", "h", "text_hash").agg(F.count("*").alias("copies"))
    carried = texts.groupBy("host", "h").agg(F.count("*").alias("documents"), F.sum("copies").alias("all_copies")).join(hosts, "host")
    by_text = (F.col("documents") > limits.min_documents) & (F.col("documents") > F.col("all") * F.lit(limits.max_share))
    by_copy = (F.col("all_copies") > limits.min_documents) & (F.col("all_copies") > F.col("all_documents") * F.lit(limits.site_share))
    counts = scratch.stage(carried.filter(by_text | by_copy).select("host", "h", "documents", by_text.alias("by_text"), by_copy.alias("by_copy")))
    frequent = scratch.stage(among(lines, counts))
    looked = among(frequent, counts.filter("by_text"))
    spread = looked.groupBy("host", "h", "around").agg(F.lit(1).alias("one"))
    spread = spread.groupBy("host", "h").agg(F.count("*").alias("spread"))
    counts = counts.join(spread, ["host", "h"], "left").join(distinct_rests(looked, limits), ["host", "h"], "left")
    surroundings = F.greatest(F.coalesce("spread", F.lit(0)), F.coalesce("rests", F.lit(0)))
    varied = F.col("by_text") & (surroundings >= F.col("documents") * F.lit(limits.min_spread))
    return counts.filter(F.col("by_copy") | varied).select("host", "h"), frequent


def removed_lines(rows: DataFrame, limits: Limits, scratch: Scratch) -> DataFrame:
    """(`k1`, `k2`, `at`s removed, their words `n_removed_words`) of the rows that lose lines."""
    lines = scratch.stage(host_lines(rows))
    above, frequent = lines_above(lines, rows, limits, scratch)
    hit = among(frequent, above)
    once = hit.groupBy("k1", "k2", "at").agg(F.max("n").alias("n"))  # equal rows share a key
    lost = once.groupBy("k1", "k2").agg(F.collect_list("at").alias("removed"), F.sum("n").alias("n_removed_words"))
    return lost.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "removed", "n_removed_words")


def judge(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per row of `docs`: `doc_id`, the five measures, `n_removed_words`, `base_failed`,
    `depleted` and `kept`.

    base_failed: fewer than 10 words, or over a fifth of them in repeated windows.
    Null text has no words (and fails), a null host is a host of its own, a null
    doc_id stays null, repeated rows are judged alike and each returned; other
    columns, whatever their names, play no part; no rows give none.
    """
    return _judged(keyed(docs, host), limits).drop("k1", "k2", "removed")


def _judged(rows: DataFrame, limits: Limits) -> DataFrame:
    lost = removed_lines(rows, limits, Scratch(rows.sparkSession))
    base = text_measures(rows, "doc_id", "k1", "k2")
    out = base.join(lost, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").drop("_k1", "_k2")
    out = out.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumns({"base_failed": failed, "depleted": _depleted(F.col("n_words"), F.col("n_removed_words"), limits)})
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def filter_documents(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The kept documents, without the lines above the limits; all columns of `docs`.
    Cases as in `judge`: null texts go, every kept row is returned."""
    verdict = _judged(keyed(docs, host), limits).filter("kept").select("k1", "k2", "removed").dropDuplicates(["k1", "k2"])
    key = row_key(F.col("doc_id"), F.col("text"), F.col(host))
    rows = as_row(docs, k1=key[0], k2=key[1]).join(verdict, ["k1", "k2"])
    lines = F.transform(F.split("row.text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    rest = F.transform(F.filter(lines, lambda p: ~F.array_contains("removed", p["i"])), lambda p: p["x"])
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(rest, "\n"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")
