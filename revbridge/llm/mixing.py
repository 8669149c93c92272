"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget; a source whose share
would repeat it more than `max_epochs` times is clamped there, and what it could
not take is shared again by weight among the rest, until no share is above its
cap.  A source then takes whole repetitions of all its documents, and for the
fractional one a seeded choice of documents.

DataFrame functions only.  The documents are never grouped by source in one
task: sizes are pre-aggregated, and the seeded choice is a running sum over
2^bits parts of each source (`common.prefix_sums`), so a source with a third of
all rows is spread like the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch, as_row, global_index, group_key, n_words, prefix_sums, uniform60


def water_fill(sources: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """Add `target` (double) to a frame of `source_size` (long) and `weight` (long).

    Rounds of clamping: a round sums what the clamped sources hold and the weights
    of the others (two numbers, whatever the number of sources), and ends when it
    clamps no more.  The sums are exact integers.  A source of size 0 gets target
    0; if all are clamped the budget cannot be met and each gets its cap.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    left, weights, clamped = budget, None, 0
    over = F.lit(False)
    while True:
        s = sources.agg(
            F.sum(F.when(over, cap)).alias("held"),
            F.sum(F.when(~over, F.col("weight"))).alias("weights"),
            F.count(F.when(over, 1)).alias("clamped"),
        ).first()
        if weights is not None and s.clamped == clamped:
            break
        left, weights, clamped = budget - (s.held or 0), s.weights or 0, s.clamped
        if not weights:
            over = F.lit(True)
            break
        over = F.lit(float(left)) * F.col("weight") / F.lit(float(weights)) > cap
    free = F.lit(float(left)) * F.col("weight") / F.lit(float(weights or 1))
    return sources.withColumn("target", F.when(over, cap.cast("double")).otherwise(free))


def source_sizes(docs: DataFrame, source: str = "source", size: Column | None = None) -> DataFrame:
    """One row per source (null is one too): `source_key`, the source, `source_size`."""
    size = n_words(F.col("text")) if size is None else size
    return (
        docs.select(group_key(F.col(source)).alias("source_key"), F.col(source), size.alias("size"))
        .groupBy("source_key").agg(F.first(source).alias(source), F.sum("size").alias("source_size"))
    )


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...], scratch: Scratch, source: str = "source") -> DataFrame:
    """Weights `cycle[0]`, `cycle[1]`, ... repeating, over the sources in code-point order, null last."""
    ranked = global_index(sources, source, "place", scratch)
    turn = F.col("place") % len(cycle)
    weight = F.lit(cycle[0])
    for i, w in enumerate(cycle[1:], 1):
        weight = F.when(turn == i, w).otherwise(weight)
    return ranked.withColumn("weight", weight.cast("long")).drop("place")


ADDED = ("size", "source_size", "target", "reps", "taken")


def mix(docs: DataFrame, weighted: DataFrame, max_epochs: int = 3, budget: int | None = None, seed: str = "mix",
        source: str = "source", size: Column | None = None, bits: int = 12) -> DataFrame:
    """Add `size`, `source_size`, `target`, `reps` and `taken` to every document.

    docs      any frame with `doc_id`, `text` and the source column; other columns
              pass through.  Columns named as the added ones are replaced.
    weighted  `source_key`, `source_size`, `weight`, one row per source
    budget    words to take in all; the sum of all sizes if None

    A document is repeated floor(target / source size) times, and once more if it
    is chosen: the chosen are the first in a seeded order, as many as bring the
    source's words nearest to its target, so the error is at most half the size of
    one document.  The order is MD5 of seed, doc_id, size and the text's own MD5, so rows
    that share a doc_id (or have none) are spread by their texts.  Null or
    empty text has size 0 and takes nothing; a null source is a source of its own;
    repeated rows count one by one; equal rows may swap places in the order, which
    leaves the result the same.  No row is dropped; an empty frame gives no rows.
    """
    rows = _mixed(docs, weighted, max_epochs, budget, seed, source, size, bits)
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ADDED], *ADDED)


def _mixed(docs: DataFrame, weighted: DataFrame, max_epochs: int, budget: int | None, seed: str, source: str, size: Column | None,
           bits: int) -> DataFrame:
    """All columns of docs as `row`, and the added ones."""
    words = n_words(F.col("text")) if size is None else size
    if budget is None:
        budget = weighted.agg(F.sum("source_size")).first()[0] or 0
    targets = water_fill(weighted, budget, max_epochs).select(
        F.col("source_key").alias("key"), "source_size", "target",
        F.floor(F.try_divide(F.col("target"), F.col("source_size"))).alias("whole"),
    ).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = as_row(docs, key=group_key(F.col(source)), size=words, digest=F.md5("text"))
    rows = rows.withColumn("u", uniform60(F.lit(seed), F.col("row.doc_id"), F.col("size"), F.col("digest")))
    rows = prefix_sums(rows, "key", "u", "size", "before", [F.col("row.doc_id"), F.col("size"), F.col("digest")], bits)
    extra = (F.col("need") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("need"))
    reps = F.coalesce(F.col("whole"), F.lit(0)) + F.when(extra, 1).otherwise(0)
    rows = rows.join(targets, "key").withColumn("reps", reps.cast("long"))
    return rows.withColumn("taken", F.col("reps") * F.col("size")).select("row", *ADDED)


def _cyclic(docs: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    return scratch.stage(cyclic_weights(source_sizes(docs), cycle, scratch))


def mix_sources(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """`mix` with weights repeating over the sources in order and a budget of all words."""
    return mix(docs, _cyclic(docs, cycle), max_epochs)


def mixed_corpus(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """The documents as `mix_sources` takes them, with their own columns: each as often
    as `reps` says (those with 0 leave)."""
    rows = _mixed(docs, _cyclic(docs, cycle), max_epochs, None, "mix", "source", None, 12).filter("reps > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int")))).select("row.*")
