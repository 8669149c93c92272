"""Exact distinct counts that can be merged.

The report adds the distinct counts of its components, so an entity or customer in two of
them counts twice.  Here every (month, component) keeps its entities and its customers as
bitmaps over dense numbers: 32,768 to a bucket, built map-side and merged by OR.  From that
one small table the distinct count of any union of components follows, and of a
difference, as |A less B| = |A or B| - |B|; the component rows are read once and no row is
expanded per count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = {"ITEM": ["entity_type", "entity_id"], "CUSTOMER": ["customer"]}
#: What is held in a month and what has left it, by kind (component lists of closing).
HELD = {"ITEM": ["R01", "R04", "R05", "R13"], "CUSTOMER": ["R01", "R04", "R05"]}
LEFT = {"ITEM": ["R07", "R08", "R10", "R11", "R12"], "CUSTOMER": ["R08", "R11"]}


def distinct_sets(rows: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(`month_num`, `component`, `kind`, `bucket`, `bits`) of component rows; rows whose key
    has a NULL are in no set, as in a distinct count.  `stage` fixes the numbers, which are
    dense inside a partition of the distinct keys and so fill whole buckets."""
    out = None
    for kind, keys in KINDS.items():
        known = rows.select("month_num", "component", *keys).dropna(subset=keys)
        numbers = stage(known.select(*keys).distinct().withColumn("_number", F.monotonically_increasing_id()))
        number = F.col("_number")
        bits = known.join(numbers, keys).groupBy("month_num", "component", F.lit(kind).alias("kind"), F.bitmap_bucket_number(number).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
        )
        out = bits if out is None else out.unionByName(bits)
    return out


def distinct_of_unions(sets: DataFrame, unions: dict[str, dict[str, list[str]]]) -> DataFrame:
    """(`month_num`, `kind`, one count per union): `unions` names lists of components per kind."""
    def member(lists: dict[str, list[str]]) -> F.Column:
        cond = F.lit(False)
        for kind, components in lists.items():
            cond = cond | ((F.col("kind") == kind) & F.col("component").isin(*components))
        return cond

    merged = sets.groupBy("month_num", "kind", "bucket").agg(*[F.bitmap_or_agg(F.when(member(lists), F.col("bits"))).alias(n) for n, lists in unions.items()])
    return merged.groupBy("month_num", "kind").agg(*[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).cast("long").alias(n) for n in unions])


def distinct_closing(sets: DataFrame, closing: DataFrame) -> DataFrame:
    """Per month and kind the entities (customers) held and those that left, each once,
    and closing both ways: distinct, and added up as A03 has it (`closing`)."""
    every = {k: HELD[k] + LEFT[k] for k in KINDS}
    counts = distinct_of_unions(sets, {"held": HELD, "left_month": LEFT, "either": every})
    added = closing.select("month_num", F.explode(F.create_map(F.lit("ITEM"), F.col("items_count"), F.lit("CUSTOMER"), F.col("cx_count"))).alias("kind", "closing_added"))
    return counts.join(added, ["month_num", "kind"], "left").select(
        "month_num", "kind", "held", "left_month", (F.col("either") - F.col("left_month")).alias("closing_distinct"), "closing_added"
    )
