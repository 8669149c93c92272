"""Swaps: the swap register (S01) and swapped-out / swapped-in revenue
(R12, R13).

The revenue of a swap is the cycle in force at the swap: the last cycle
starting on/before the fulfilment date (swap out) or the first starting
on/after it (swap in).  That as-of match is a union of cycles and swap events
per entity with `last`/`first` over the ordered window, not a range join
that pairs every swap with every cycle of the entity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revbridge.functions import ist_date
from revbridge.operators.movements import bucket, within
from revbridge.policy import Policy
from revbridge.sources.ledger import SWAP_COLUMNS, Ledger

KEYS = ["entity_id", "entity_type"]


def swap_register(L: Ledger) -> DataFrame:
    """Every swap of an attachment plus fulfilled swap-outs of items
    (the register's filter applies to its item branch only)."""
    cols = ["id", *SWAP_COLUMNS]
    a = L.swap_attachments.select(*cols, F.col("attachment_id").alias("entity_id"), F.lit("ATTACHMENT").alias("entity_type"))
    i = L.swap_items.filter((F.col("action") == "SWAP_OUT") & (F.col("state") == "FULFILLED")).select(
        *cols, F.col("item_id").alias("entity_id"), F.lit("ITEM").alias("entity_type")
    )
    return a.unionByName(i)


def swap_events(L: Ledger, policy: Policy | None = None) -> DataFrame:
    """Fulfilled swaps (one per entity, action and IST fulfilment date); with a
    policy only those that can fall in its months (a day wider, for IST)."""
    day = dt.timedelta(days=1)
    in_months = F.lit(True) if policy is None else within("fulfillment_date", policy.first_start - day, policy.last_next + day)

    def side(df: DataFrame, id_col: str, kind: str) -> DataFrame:
        return df.filter(
            (F.col("state") == "FULFILLED")
            & in_months
            & F.col("fulfillment_date").isNotNull()
            & F.col("action").isin("SWAP_OUT", "SWAP_IN")
        ).select(
            F.col(id_col).alias("entity_id"), F.lit(kind).alias("entity_type"), "action",
            ist_date("fulfillment_date").alias("fulfillment_date"),
        )

    return side(L.swap_attachments, "attachment_id", "ATTACHMENT").unionByName(
        side(L.swap_items, "item_id", "ITEM")
    ).distinct()


def one_swap_per_action(events: DataFrame) -> DataFrame:
    """Of an entity's swaps the last one out and the first one in.

    Ranking the cycles before all swaps out of an entity by start (or after all swaps in)
    finds the cycle of that one swap, so a grouped aggregate replaces the rank over swap x cycle pairs."""
    day = F.col("fulfillment_date")
    one = F.when(F.col("action") == "SWAP_OUT", F.max(day)).otherwise(F.min(day))
    return events.groupBy(*KEYS, "action").agg(one.alias("fulfillment_date"))


def swap_matches(events: DataFrame, entity_cycles: DataFrame) -> DataFrame:
    """As-of match of each swap event to a cycle amount.

    Only cycles of swapped entities are dealt and sorted, once for swaps out and in.
    Ties on cycle start resolve to the larger amount in both directions.
    """
    cyc = entity_cycles.select(
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("accountable_entity_type").alias("entity_type"),
        F.to_date("rr_start_date").alias("d"),
        F.col("taxable_amount").alias("amt"),
    ).join(events.select(*KEYS).distinct(), KEYS, "left_semi")
    # on a day: swaps in (0), cycles (1), swaps out (2)
    k = F.when(F.col("action") == "SWAP_IN", 0).when(F.col("action") == "SWAP_OUT", 2)
    ev = events.select(*KEYS, "action", F.col("fulfillment_date").alias("d"), k.alias("k")).filter(F.col("k").isNotNull())
    rows = ev.unionByName(cyc.withColumn("k", F.lit(1)), allowMissingColumns=True)
    # swap out: same-day cycles by ascending amount, so the last cycle seen is the
    # latest start with the largest amount; swap in: by descending amount, so the
    # first one seen is the earliest start with the largest amount
    w_out = Window.partitionBy(*KEYS).orderBy("d", "k", "amt").rowsBetween(Window.unboundedPreceding, 0)
    w_in = Window.partitionBy(*KEYS).orderBy("d", "k", F.col("amt").desc()).rowsBetween(0, Window.unboundedFollowing)
    matched = rows.withColumns({"out": F.last("amt", ignorenulls=True).over(w_out), "in": F.first("amt", ignorenulls=True).over(w_in)}).filter(F.col("k") != 1)
    return matched.select(*KEYS, "action", F.col("d").alias("fulfillment_date"), F.when(F.col("k") == 2, F.col("out")).otherwise(F.col("in")).alias("taxable_amount"))


def swap_peers(events: DataFrame, entity_cycles: DataFrame) -> DataFrame:
    """Every cycle that a swap could mean: all that start at the matched start.

    The matched start (the last on or before a swap out, the first on or after a swap in)
    is an as-of match over the distinct starts of swapped entities; its peers then meet the
    swap by equality.  One row per swap and peer (`peers` of them, `place` by amount), one
    without a cycle where there is none."""
    cyc = entity_cycles.select(
        F.col("accountable_entity_id").alias("entity_id"), F.col("accountable_entity_type").alias("entity_type"),
        F.to_date("rr_start_date").alias("cycle_start"), "taxable_amount",
    ).join(events.select(*KEYS).distinct(), KEYS, "left_semi")
    out = F.col("action") == "SWAP_OUT"
    swaps = events.select(*KEYS, "action", F.col("fulfillment_date").alias("d"))
    starts = cyc.select(*KEYS, F.col("cycle_start").alias("d")).dropna().distinct().withColumn("start", F.col("d"))
    rows = swaps.withColumn("k", F.lit(1)).unionByName(starts.withColumn("k", F.lit(0)), allowMissingColumns=True)
    before = Window.partitionBy(*KEYS).orderBy("d", "k").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*KEYS).orderBy("d", F.col("k").desc()).rowsBetween(0, Window.unboundedFollowing)
    matched = rows.select(
        *KEYS, "action", "d", "k", F.last("start", ignorenulls=True).over(before).alias("past"), F.first("start", ignorenulls=True).over(after).alias("next")
    ).filter("k = 1").select(*KEYS, "action", F.col("d").alias("fulfillment_date"), F.when(out, F.col("past")).otherwise(F.col("next")).alias("cycle_start"))
    swap = Window.partitionBy(*KEYS, "action", "fulfillment_date")
    return matched.join(cyc, [*KEYS, "cycle_start"], "left").select(
        *KEYS, "action", "fulfillment_date", "cycle_start", "taxable_amount",
        F.when(F.col("cycle_start").isNotNull(), F.count("*").over(swap)).otherwise(0).alias("peers"),
        F.row_number().over(swap.orderBy(F.col("taxable_amount").desc())).alias("place"),
    )


def swap_rows(matches: DataFrame, directory: DataFrame, months: DataFrame) -> DataFrame:
    """R12 / R13 entity rows (customers are not counted for swaps)."""
    users = directory.select(F.col("id").alias("entity_id"), "entity_type", "user_id")
    return bucket(matches, "fulfillment_date", months).join(users, KEYS, "left").select(
        "month_num",
        F.when(F.col("action") == "SWAP_OUT", "R12").otherwise("R13").alias("component"),
        "entity_type", "entity_id",
        F.col("user_id").cast("string").alias("customer"),
        F.coalesce(F.col("taxable_amount"), F.lit(0).cast("decimal(18,2)")).alias("amount"),
    )
