"""Churn product (C01-C09): per-item return / buy-out transactions, their
FULL or PARTIAL scope, and the churn table the bridge reads.

Skew: every per-user question (how many items did the user still hold when
this transaction happened / at this pickup) is answered with sweeps over one
interval per item instead of a per-user self-join, so the work is linear in the
number of items and a user holding a third of all items is split by instant.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revbridge.functions import ist, is_paid, money
from revbridge.functions.frames import Frames
from revbridge.operators.sweep import covering_any, interval_events, stab_counts
from revbridge.policy import EXCLUDED_RR_STATES, TXN_BUYOUT, TXN_RETURN, Policy
from revbridge.sources.ledger import Ledger

GROUP = ["transaction_id", "user_id", "transaction_type"]


def rental_items(L: Ledger, policy: Policy) -> DataFrame:
    return L.items.filter((F.col("vertical") == policy.vertical) & (F.col("state") != "CANCELLED"))


def item_transactions(L: Ledger, policy: Policy) -> DataFrame:
    """One row per (item, live return, paid buy-out) combination.

    Return only -> the return; buy-out only -> the buy-out order; neither ->
    as-of date + 1 day and no transaction; both -> NULL transaction (the
    ledger's CASE falls through).
    """
    ri = L.return_items.filter(F.col("state") != "CANCELLED").select(
        F.col("item_id").alias("id"),
        F.col("state").alias("return_item_state"),
        "return_id",
        F.col("created_at").alias("ri_created_at"),
        F.col("updated_at").alias("ri_updated_at"),
    )
    rtp = L.rtp_items.filter(is_paid("payment_details")).select(
        F.col("item_id").alias("id"), "rent_to_purchase_order_id", "payableafterpaymentoffers"
    )
    rto = L.rtp_orders.select(F.col("id").alias("rent_to_purchase_order_id"), F.col("created_at").alias("rto_created_at"))
    # buy-out lines meet their orders first: items without one never join on a NULL order
    bought = rtp.join(rto, "rent_to_purchase_order_id", "left")
    j = (
        rental_items(L, policy)
        .select("id", "activation_date", "user_id")
        .join(ri, "id", "left")
        .join(bought, "id", "left")
    )
    no_ret, no_tto = F.col("ri_created_at").isNull(), F.col("rto_created_at").isNull()
    as_of_next = F.lit(policy.as_of + dt.timedelta(days=1)).cast("timestamp_ntz")
    return j.select(
        F.col("id").alias("item_id"),
        "activation_date",
        "return_item_state",
        "user_id",
        F.when(no_ret & no_tto, F.lit(None).cast("long"))
        .when(no_tto, F.col("return_id"))
        .when(no_ret, F.col("rent_to_purchase_order_id"))
        .alias("transaction_id"),
        F.when(no_ret & no_tto, as_of_next)
        .when(no_tto, ist("ri_created_at"))
        .when(no_ret, ist("rto_created_at"))
        .alias("item_transaction_date"),
        F.nullif(F.get_json_object(F.col("payableafterpaymentoffers").cast("string"), "$.byCashPreTax"), F.lit("")).alias(
            "tto_pay"
        ),
        F.when(no_ret & no_tto, F.lit(None).cast("string"))
        .when(no_tto, F.lit(TXN_RETURN))
        .when(no_ret, F.lit(TXN_BUYOUT))
        .alias("transaction_type"),
        ist("ri_updated_at").alias("return_item_updated_at"),
    )


def held_intervals(txn: DataFrame) -> DataFrame:
    """One row per item: it is held from its activation up to its last
    transaction date (an item may have several live transactions)."""
    return txn.groupBy("item_id", "user_id", "activation_date").agg(F.max("item_transaction_date").alias("held_to")).filter(
        F.col("held_to").isNotNull()
    )


def user_item_cross(txn: DataFrame) -> DataFrame:
    """C02 (aggregated): for each transacted item, the number of the user's
    items activated before the transaction (`earlier_items`) and how many of
    those were transacted on/after it (`still_held`).  The reference
    materialises every (item, earlier item) pair; only these counts are used.
    """
    base = txn.filter(F.col("transaction_id").isNotNull()).select(
        "user_id",
        F.col("item_transaction_date").alias("time"),
        F.col("item_id").alias("base_item_id"),
        "transaction_id",
        "transaction_type",
    ).distinct()
    items = txn.select("item_id", "user_id", "activation_date").distinct().withColumn("never", F.lit(None).cast("timestamp_ntz"))
    activated = interval_events(items, ["user_id"], "activation_date", "never", closed=True)
    held = interval_events(held_intervals(txn), ["user_id"], "activation_date", "held_to", closed=True)
    out = stab_counts(activated, base, ["user_id"], out="earlier_items")
    out = stab_counts(held, out, ["user_id"], out="still_held")
    # rows whose user is NULL never match an earlier item
    missing = base.filter(F.col("user_id").isNull()).select(
        "user_id", "time", "base_item_id", "transaction_id", "transaction_type",
        F.lit(0).cast("long").alias("earlier_items"), F.lit(0).cast("long").alias("still_held"),
    )
    return out.unionByName(missing).withColumnRenamed("time", "transaction_date")


def transaction_scope(txn: DataFrame, cut=None) -> DataFrame:
    """FULL when a transaction has as many items as its user held at its
    date (at any of its dates, each item once), else PARTIAL.

    An item is held at a date after its activation and up to its last own
    transaction.  A transaction without a user matches no held item.
    """
    base = txn.filter(F.col("transaction_id").isNotNull())
    sizes = base.groupBy(*GROUP).agg(F.count_distinct("item_id").alias("n_items"))
    dates = base.select(*GROUP, F.col("item_transaction_date").alias("time")).distinct()
    covered = covering_any(held_intervals(txn), dates, "user_id", GROUP, "activation_date", "held_to", closed=True, out="n_held", cut=cut)
    return sizes.join(covered, GROUP, "left").select(
        *GROUP,
        F.when(F.col("n_items") == F.coalesce(F.col("n_held"), F.lit(0)), "FULL").otherwise("PARTIAL").alias(
            "full_or_partial_flag"
        ),
    )


def transaction_detail(L: Ledger, txn: DataFrame, scope: DataFrame, policy: Policy) -> DataFrame:
    """One row per transacted item with price, contact, flags and pickup
    date (buy-out date for buy-outs, the item's own pickup otherwise)."""
    sc = scope.select(
        "transaction_id", "transaction_type", F.col("full_or_partial_flag").alias("transaction_type_detail")
    )
    t = txn.filter(F.col("transaction_id").isNotNull()).select(
        "item_id", "return_item_state", "transaction_id", "transaction_type", "item_transaction_date",
        "tto_pay", "return_item_updated_at",
    )
    i = L.items.select(
        F.col("id").alias("item_id"),
        F.col("name").alias("item_name"),
        "composite_item_id",
        F.get_json_object(F.col("pricing_details").cast("string"), "$.basePrice").alias("base_price"),
        "user_id",
        ist("activation_date").alias("activation_date"),
        F.col("pickup_date").alias("item_pickup_date"),
        "bundle_id", "contact", "user_name", "email_id", F.col("display_id").alias("fur_id"), "is_migrated", "is_autopay_enabled",
    )
    as_of = F.lit(policy.as_of).cast("date")
    return (
        i.join(t, "item_id")
        .join(sc, ["transaction_id", "transaction_type"], "left")
        .select(
            "item_id", "item_name", "return_item_state", "composite_item_id", "base_price", "user_id",
            "activation_date",
            F.when(F.col("transaction_type") == TXN_BUYOUT, F.col("item_transaction_date"))
            .otherwise(F.col("item_pickup_date"))
            .alias("pickup_date"),
            F.col("item_transaction_date").alias("payment_date"),
            F.col("tto_pay").try_cast("decimal(18,2)").alias("tto_amount"),
            "transaction_type", "transaction_id", "transaction_type_detail", "return_item_updated_at",
            "bundle_id", "contact", "user_name", "email_id", "fur_id", "is_migrated", "is_autopay_enabled",
            F.lit("NA").alias("ufdiscount_config"), as_of.alias("charge_till_date"),
            F.col("item_transaction_date").alias("applicable_on"), as_of.alias("updated_at"),
        )
        .distinct()
    )


def rental_item_base(L: Ledger, policy: Policy, detail: DataFrame) -> DataFrame:
    """Live rental items with their transaction detail (if any)."""
    d = detail.withColumnRenamed("item_id", "item_ids").drop("user_id")
    ri = rental_items(L, policy).select(
        F.col("id").alias("item_ids"),
        F.col("user_id").alias("user_ids"),
        "order_id",
        F.col("activation_date").alias("activation_dates"),
    )
    return ri.join(d, "item_ids", "left")


def remaining_item_count(rib: DataFrame, cut=None) -> DataFrame:
    """Other items of the user active at this item's pickup (activated
    before it, not picked up by then); at any of them if it has several.

    An item is active after its activation and before its last pickup, without
    end if any of its rows has none.  What the item adds to its own count is
    taken off again.
    """
    items = rib.groupBy("item_ids", "user_ids", "activation_dates").agg(
        F.max("pickup_date").alias("last_pickup"),
        F.min("pickup_date").alias("first_pickup"),
        F.max(F.col("pickup_date").isNull().cast("int")).alias("open"),
        F.array_distinct(F.collect_list("pickup_date")).alias("pickups"),
    )
    until = F.when(F.col("open") == 0, F.col("last_pickup"))
    intervals = items.select("item_ids", "user_ids", "activation_dates", until.alias("active_to"))
    asked = rib.filter(F.col("pickup_date").isNotNull()).select("user_ids", "item_ids", F.col("pickup_date").alias("time")).distinct()
    counted = covering_any(
        intervals, asked, "user_ids", ["user_ids", "item_ids"], "activation_dates", "active_to", closed=False, out="n_active", cut=cut
    ).select("item_ids", "n_active")
    own = F.exists("pickups", lambda p: (F.col("activation_dates") < p) & ((F.col("open") == 1) | (p < F.col("last_pickup"))))
    return items.join(counted, "item_ids", "left").select(
        "item_ids",
        F.coalesce(F.col("n_active") - own.cast("int"), F.lit(0)).cast("long").alias("later_items_count"),
    )


def churn_flag(rib: DataFrame, counts: DataFrame) -> DataFrame:
    """ACTIVE (no pickup) / PARTIAL (other items still held) / FULL."""
    return rib.join(counts, "item_ids").withColumn(
        "churn_flag",
        F.when(F.col("pickup_date").isNull(), "ACTIVE")
        .when(F.col("later_items_count") > 0, "PARTIAL")
        .otherwise("FULL"),
    )


def _rr(L: Ledger, kind: str) -> DataFrame:
    return L.recognitions.filter(
        (F.col("accountable_entity_type") == kind) & ~F.col("state").isin(*EXCLUDED_RR_STATES)
    ).select(
        F.col("accountable_entity_id").alias("rr_entity_id"),
        "start_date", "end_date", "recognised_at", "taxable_amount",
    )


def _cycle_amount(policy: Policy) -> F.Column:
    months = F.round(
        F.datediff(F.to_date("end_date"), F.to_date("start_date")).cast("decimal(10,0)")
        / F.lit(policy.churn_days_per_month),
        0,
    )
    return F.round(F.try_divide(money("taxable_amount"), F.nullif(months, F.lit(0))), 2).cast("decimal(18,2)")


KEEP = [
    "user_ids", "activation_date", "return_item_state", "base_price", "fur_id", "pickup_date", "payment_date",
    "tto_amount", "transaction_type", "transaction_id", "transaction_type_detail", "churn_flag",
]


def item_churn_amount(L: Ledger, policy: Policy, tagged: DataFrame) -> DataFrame:
    """Each item cycle's monthly amount, loss day/month and recency rank
    (DENSE_RANK by start, latest first; ties keep rank 1)."""
    rr = _rr(L, "ITEM")
    j = tagged.join(rr, tagged.item_ids == rr.rr_entity_id, "left")
    w = Window.partitionBy("item_ids").orderBy(F.col("start_date").desc())
    return j.select(
        F.col("item_ids").alias("entity_id"),
        F.lit("ITEM").alias("entity_type"),
        *KEEP,
        "start_date", "end_date",
        _cycle_amount(policy).alias("taxable_amount"),
        F.trunc(F.date_add(F.to_date("end_date"), 1), "month").alias("revenue_loss_month"),
        F.date_add(F.to_date("end_date"), 1).alias("revenue_loss_day"),
        F.dense_rank().over(w).alias("rnk"),
    )


def attachment_churn_amount(L: Ledger, policy: Policy, tagged: DataFrame) -> DataFrame:
    """The same for attachments sharing the churned item's composite id."""
    att = L.attachments.select(F.col("id").alias("attachment_id"), "composite_item_id")
    rr = _rr(L, "ATTACHMENT")
    j = (
        tagged.filter(F.col("churn_flag") != "ACTIVE")
        .join(att, "composite_item_id")
        .join(rr, F.col("attachment_id") == F.col("rr_entity_id"))
    )
    w = Window.partitionBy("attachment_id").orderBy(F.col("start_date").desc())
    return j.select(
        F.col("attachment_id").alias("entity_id"),
        F.lit("ATTACHMENT").alias("entity_type"),
        *KEEP,
        "start_date", "end_date",
        _cycle_amount(policy).alias("taxable_amount"),
        F.trunc(F.date_add(F.to_date("end_date"), 1), "month").alias("revenue_loss_month"),
        F.date_add(F.to_date("end_date"), 1).alias("revenue_loss_day"),
        F.dense_rank().over(w).alias("rnk"),
    )


def latest_cycles(L: Ledger, policy: Policy, rows: DataFrame, stage=lambda df: df) -> DataFrame:
    """Rank-1 rows of the churn table for `rows`, churned rows of C06: their item's
    and its attachments' latest cycles (all of one start).

    A rank depends on the entity's cycles only, so only the entities of `rows` are
    ranked: their cycles are found by a semi-join in one scan, and the latest start of
    each is a grouped maximum (`stage` cuts off the entities, so that the planner knows
    how few they are, and their cycles)."""
    att = L.attachments.select(F.col("id").alias("entity_id"), "composite_item_id").filter(F.col("composite_item_id").isNotNull())
    items = rows.withColumns({"entity_id": F.col("item_ids"), "entity_type": F.lit("ITEM")})
    atts = rows.join(att, "composite_item_id").withColumn("entity_type", F.lit("ATTACHMENT"))

    keys = ["entity_id", "entity_type"]
    churned = stage(items.select(*keys, *KEEP).unionByName(atts.select(*keys, *KEEP)))
    rr = L.recognitions.filter(F.col("accountable_entity_type").isin("ITEM", "ATTACHMENT") & ~F.col("state").isin(*EXCLUDED_RR_STATES)).select(
        F.col("accountable_entity_id").alias("entity_id"), F.col("accountable_entity_type").alias("entity_type"), "start_date", "end_date", "taxable_amount"
    )
    own = stage(rr.join(churned.select(*keys).distinct(), keys, "left_semi"))
    last = own.groupBy(*keys).agg(F.max("start_date").alias("_last"))
    top = own.join(last, keys).filter(F.col("start_date").eqNullSafe(F.col("_last")))
    found = churned.join(
        top.select(*keys, "start_date", "end_date", _cycle_amount(policy).alias("taxable_amount"), F.lit(True).alias("_found")), keys, "left"
    )
    return found.filter((F.col("entity_type") == "ITEM") | F.col("_found")).drop("_found")  # an attachment without cycles has no row


def items_of_months(L: Ledger, policy: Policy, txn: DataFrame) -> DataFrame:
    """Ids of the items that can have a churned row dated in the months."""
    def inside(column: str) -> F.Column:
        return F.to_date(column).between(F.lit(policy.first_start), F.lit(policy.last_next - dt.timedelta(days=1)))

    ids = txn.filter(F.col("transaction_id").isNotNull() & inside("item_transaction_date")).select("item_id")
    if policy.churn_bucket != "payment":
        ids = ids.unionByName(L.items.filter(inside("pickup_date")).select(F.col("id").alias("item_id")))
    return ids.filter(F.col("item_id").isNotNull()).distinct()


def tagged_of_months(L: Ledger, policy: Policy, txn: DataFrame, stage=lambda df: df, cut=None) -> DataFrame:
    """The rows of C06 of the items with a transaction dated in the months, as the whole
    pipeline has them.

    They depend on all transactions of the item, on all users of these transactions and on
    all items of these users, and on nothing else: only those go through the sweeps.  An
    item or a transaction may belong to several users, so each step goes by the rows of
    `txn` (which holds every rental item); a NULL user holds nothing, so it draws in no
    other items.  `stage` cuts off the short lists, so that the planner knows their size."""
    asked = ["transaction_id", "transaction_type"]
    ids = stage(items_of_months(L, policy, txn))
    own = txn.join(ids, "item_id", "left_semi")
    shared = txn.join(stage(own.filter(F.col("transaction_id").isNotNull()).select(*asked).distinct()), asked, "left_semi")
    near = stage(own.select("item_id", "user_id").unionByName(shared.select("item_id", "user_id")).distinct())
    held = txn.join(near.select("user_id").distinct(), "user_id", "left_semi")
    items = stage(near.select("item_id").unionByName(held.select("item_id")).distinct())
    few = replace(L, items=stage(L.items.join(items.withColumnRenamed("item_id", "id"), "id", "left_semi")))
    txn = stage(txn.join(items, "item_id", "left_semi"))
    rib = stage(rental_item_base(few, policy, transaction_detail(few, txn, transaction_scope(txn, cut), policy)))
    return churn_flag(rib.join(ids.withColumnRenamed("item_id", "item_ids"), "item_ids", "left_semi"), remaining_item_count(rib, cut))


def churn_pipeline(L: Ledger, policy: Policy, stage=lambda df: df, cut=None) -> dict[str, DataFrame]:
    """All churn frames, each built when asked for; `stage` marks the frames read by
    several consumers (persist / checkpoint) so each is computed once, `cut` those that
    the sweeps read several times (default: a checkpoint)."""
    def table() -> DataFrame:
        # all rows of an item share its cycles, so ranks are the same without the ACTIVE rows
        churned = item_churn_amount(L, policy, f["tagged"].filter(F.col("churn_flag") != "ACTIVE"))
        return churned.unionByName(f["attachment_amounts"]).withColumn(
            "refreshed_at", F.lit(dt.datetime.combine(policy.as_of, dt.time())).cast("timestamp_ntz")
        )

    f = Frames({
        "transactions": lambda: stage(item_transactions(L, policy)),
        "scope": lambda: transaction_scope(f["transactions"], cut),
        "detail": lambda: transaction_detail(L, f["transactions"], f["scope"], policy),
        "item_base": lambda: stage(rental_item_base(L, policy, f["detail"])),
        "counts": lambda: remaining_item_count(f["item_base"], cut),
        "tagged": lambda: stage(churn_flag(f["item_base"], f["counts"])),
        "item_amounts": lambda: item_churn_amount(L, policy, f["tagged"]),
        "attachment_amounts": lambda: attachment_churn_amount(L, policy, f["tagged"]),
        "table": table,
    })
    return f


def churn_table(L: Ledger, policy: Policy) -> DataFrame:
    """The churn table (items and attachments, ACTIVE rows removed)."""
    return churn_pipeline(L, policy)["table"]


def write_churn_table(df: DataFrame, path: str | None = None, table: str | None = None,
                      mode: str = "overwrite") -> None:
    """CTAS equivalent: persist the churn table for the bridges, either as a
    catalog table (`table`, saveAsTable) or as parquet files (`path`)."""
    writer = df.write.mode(mode)
    if table is not None:
        writer.saveAsTable(table)
    elif path is not None:
        writer.parquet(path)
    else:
        raise ValueError("give a table name or a path")
