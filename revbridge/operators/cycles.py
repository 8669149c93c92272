"""Cycle labelling product (L01-L10, L07T): every billing cycle of the
analysis months with its return / buy-out window, churn flag, MTP class and a
single primary label, plus the entity's lifecycle pattern.

Runs over the whole ledger (`entity_id` narrows it to one entity, as the
drill-down does).  The month classification derives each rule's month from
the cycle's own dates and joins the tiny month driver on equality (no
cross join); per-entity context uses windows partitioned by entity, whose
size is bounded by the entity's number of cycles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revbridge.functions import ist_date, is_paid, money
from revbridge.functions.frames import Frames
from revbridge.operators.base import ENTITY_KEYS
from revbridge.operators.movements import within
from revbridge.policy import EXCLUDED_RR_STATES, Policy
from revbridge.sources.ledger import Ledger

CYCLE = [*ENTITY_KEYS, "cycle_start_date", "cycle_end_date"]
CLASS_RANK = {"CURRENT_MTP": 1, "MTP": 2, "NORMAL_CYCLE": 3}


def labelling_cycles(L: Ledger, policy: Policy, entity_id=None, in_months: bool = False) -> DataFrame:
    """Live cycles; `in_months` keeps those that start or were recognised from the month
    before the first one to the last (bounds on the raw columns, for the scan): without a
    buy-out no other cycle belongs to a month."""
    rr = L.recognitions.filter(
        (F.col("vertical") == policy.vertical)
        & ~F.col("state").isin(*EXCLUDED_RR_STATES)
        & F.col("deleted_at").isNull()
        & F.col("accountable_entity_type").isin("ITEM", "ATTACHMENT")
    )
    if entity_id is not None:
        rr = rr.filter(F.col("accountable_entity_id") == entity_id)
    if in_months:
        day = dt.timedelta(days=1)  # recognition is bucketed by IST date
        low, high = policy.first_prev_start, policy.last_next
        rr = rr.filter(within("start_date", low, high) | within("recognised_at", low - day, high + day))
    return rr.select(
        *ENTITY_KEYS,
        F.to_date("start_date").alias("cycle_start_date"),
        F.to_date("end_date").alias("cycle_end_date"),
        "recognised_at",
        ist_date("recognised_at").alias("recognised_at_ist"),
        "recognition_type",
        money("taxable_amount").alias("cycle_taxable_amount"),
    )


def return_in_cycle(cycles: DataFrame, L: Ledger) -> DataFrame:
    """Live return (item or attachment) whose IST date is in the cycle."""
    def side(df, id_col, kind):
        return df.filter(F.col("state") != "CANCELLED").select(
            F.col(id_col).alias("r_entity_id"), F.lit(kind).alias("r_entity_type"),
            F.col("id").alias("return_item_id"), F.col("state").alias("return_item_state"),
            ist_date("created_at").alias("return_created_at_ist"),
        )

    r = side(L.return_items, "item_id", "ITEM").unionByName(side(L.return_attachments, "attachment_id", "ATTACHMENT"))
    cond = (
        (cycles.accountable_entity_id == r.r_entity_id)
        & (cycles.accountable_entity_type == r.r_entity_type)
        & r.return_created_at_ist.between(cycles.cycle_start_date, cycles.cycle_end_date)
    )
    return cycles.join(r, cond, "left").drop("r_entity_id", "r_entity_type").withColumn(
        "has_return_in_window", F.col("return_item_id").isNotNull()
    )


def return_routes(L: Ledger) -> DataFrame:
    """Live returns by the entity they end: its own, and for an attachment also those of
    the items (not cancelled) that share its composite id.  Two disjoint equi-joins; no
    return meets an attachment on a missing composite id."""
    def side(df: DataFrame, id_col: str) -> DataFrame:
        return df.filter(F.col("state") != "CANCELLED").select(
            F.col(id_col).alias("r_entity_id"), F.col("id").alias("return_item_id"), F.col("state").alias("return_item_state"), "created_at"
        )

    of_items = side(L.return_items, "item_id")
    parents = L.items.filter((F.col("state") != "CANCELLED") & F.col("composite_item_id").isNotNull()).select(
        F.col("id").alias("r_entity_id"), "composite_item_id"
    )
    attachments = L.attachments.select(F.col("id").alias("attachment_id"), "composite_item_id")
    through = (
        of_items.join(parents, "r_entity_id").drop("r_entity_id").join(attachments, "composite_item_id").drop("composite_item_id")
        .withColumnRenamed("attachment_id", "r_entity_id")
    )
    named = lambda df, kind, route: df.withColumns({"r_entity_type": F.lit(kind), "return_route": F.lit(route)})
    return (
        named(of_items, "ITEM", "DIRECT")
        .unionByName(named(side(L.return_attachments, "attachment_id"), "ATTACHMENT", "DIRECT"))
        .unionByName(named(through, "ATTACHMENT", "PARENT"))
        .withColumn("return_created_at_ist", ist_date("created_at"))
    )


def return_through_parent(cycles: DataFrame, L: Ledger) -> DataFrame:
    """Every cycle once, with the return that falls into it by either route.

    A parent's return goes before the attachment's own, then the earliest, then the
    smallest id; which routes there are is kept beside it.  Candidates are merged per
    cycle by an aggregate, so that several parents, returns or shared composite ids
    never multiply a cycle."""
    r = return_routes(L)
    spans = cycles.select(*CYCLE).distinct()
    cond = (
        (spans.accountable_entity_id == r.r_entity_id) & (spans.accountable_entity_type == r.r_entity_type)
        & r.return_created_at_ist.between(spans.cycle_start_date, spans.cycle_end_date)
    )
    first = F.struct((F.col("return_route") == "DIRECT").alias("later"), "created_at", "return_item_id", "return_item_state", "return_created_at_ist", "return_route")
    found = spans.join(r, cond).groupBy(*CYCLE).agg(
        F.min(first).alias("r"), F.max(F.col("return_route") == "DIRECT").alias("returned_directly"), F.max(F.col("return_route") == "PARENT").alias("returned_with_parent")
    )
    no = F.lit(False)
    return cycles.join(found, CYCLE, "left").select(
        *cycles.columns, "r.return_item_id", "r.return_item_state", "r.return_created_at_ist", "r.return_route",
        F.coalesce("returned_directly", no).alias("returned_directly"), F.coalesce("returned_with_parent", no).alias("returned_with_parent"),
        F.col("r").isNotNull().alias("has_return_in_window"),
    )


def paid_buyouts(L: Ledger) -> DataFrame:
    """Paid buy-out lines of items and attachments."""
    def side(t, id_col, kind):
        return t.filter(is_paid("payment_details")).select(
            F.col(id_col).alias("b_entity_id"), F.lit(kind).alias("b_entity_type"),
            F.col("id").alias("rent_to_purchase_item_id"), F.col("rent_to_purchase_order_id").alias("b_order_id"),
        )

    return side(L.rtp_items, "item_id", "ITEM").unionByName(side(L.rtp_attachments, "attachment_id", "ATTACHMENT"))


def buyout_in_cycle(df: DataFrame, L: Ledger) -> DataFrame:
    """Paid buy-out of the entity whose (non-cancelled) order date is in
    the cycle; the buy-out line is reported even when its order is not."""
    rtp = paid_buyouts(L)
    rto = L.rtp_orders.filter(F.col("state") != "CANCELLED").select(
        F.col("id").alias("b_order_id"), ist_date("created_at").alias("b_created_at_ist")
    )
    # lines meet their orders first: cycles without a buy-out never join on a NULL order
    bought = rtp.join(rto, "b_order_id", "left").drop("b_order_id")
    j = df.join(
        bought, (df.accountable_entity_id == bought.b_entity_id) & (df.accountable_entity_type == bought.b_entity_type), "left"
    )
    inside = F.coalesce(F.col("b_created_at_ist").between(F.col("cycle_start_date"), F.col("cycle_end_date")), F.lit(False))
    return j.select(
        *df.columns, "rent_to_purchase_item_id",
        F.when(inside, F.col("b_created_at_ist")).alias("rtp_created_at_ist"),
        inside.alias("has_rtp_in_window"),
    )


def entity_churn_flags(tagged: DataFrame, L: Ledger) -> DataFrame:
    """Entity-grain churn flags: churned items plus the attachments sharing
    their composite id (the labelling product's own churn view)."""
    items = tagged.filter(F.col("churn_flag") != "ACTIVE")
    att = L.attachments.select(F.col("id").alias("att_id"), F.col("composite_item_id").alias("att_composite"))
    a = items.join(att, items.composite_item_id == att.att_composite).select(
        F.col("att_id").alias("c_entity_id"), F.lit("ATTACHMENT").alias("c_entity_type"),
        "user_ids", "transaction_type", "churn_flag",
    )
    i = items.select(
        F.col("item_ids").alias("c_entity_id"), F.lit("ITEM").alias("c_entity_type"),
        "user_ids", "transaction_type", "churn_flag",
    )
    return i.unionByName(a)


def published_churn_flags(churn_table: DataFrame) -> DataFrame:
    """Entity-grain churn flags of a published churn table, whose rows are entity x cycle."""
    return churn_table.filter(F.col("churn_flag") != "ACTIVE").select(
        F.col("entity_id").alias("c_entity_id"), F.col("entity_type").alias("c_entity_type"), "user_ids", "transaction_type", "churn_flag",
    ).distinct()


def churn_enrichment(df: DataFrame, flags: DataFrame, returns_only: bool = False) -> DataFrame:
    """Churn flag of the entity, for cycles holding a return or buy-out (or a return only)."""
    ended = df.has_return_in_window if returns_only else df.has_return_in_window | df.has_rtp_in_window
    cond = (
        (df.accountable_entity_id == flags.c_entity_id)
        & (df.accountable_entity_type == flags.c_entity_type)
        & ended
    )
    return df.join(flags, cond, "left").select(
        *df.columns,
        F.col("churn_flag").alias("churn_classification"),
        F.col("transaction_type").alias("churn_transaction_type"),
        F.col("user_ids").alias("churn_user_id"),
    )


def lifecycle_context(df: DataFrame) -> DataFrame:
    """Entity-wide latest buy-out date, cycles starting after it, the
    buy-out adjusted recognition date and whether it was used."""
    g = F.col("global_tto_date")
    start, rec, rtp = F.col("cycle_start_date"), F.col("recognised_at_ist"), F.col("rtp_created_at_ist")
    # only entities with a buy-out have a date and cycles after it: small aggregates, no window over all cycles
    last = df.filter(rtp.isNotNull()).groupBy(*ENTITY_KEYS).agg(F.max("rtp_created_at_ist").alias("global_tto_date"))
    after = df.select(*ENTITY_KEYS, "cycle_start_date").join(last, ENTITY_KEYS).groupBy(*ENTITY_KEYS, "global_tto_date").agg(
        F.count(F.when(start > g, 1)).alias("future_cycles_count")
    )
    return df.join(after, ENTITY_KEYS, "left").select(
        *df.columns, "global_tto_date",
        F.coalesce(F.col("future_cycles_count"), F.lit(0)).alias("future_cycles_count"),
        F.when(start > g, g).when((rec > rtp) & rtp.isNotNull(), rtp).otherwise(rec).alias("synthetic_recognised_at_ist"),
        F.coalesce((start > g) | ((rec > rtp) & rtp.isNotNull()), F.lit(False)).alias("used_tto_date_for_pattern"),
    )


def month_context(L: Ledger, policy: Policy, entity_id=None) -> DataFrame:
    """L04 (without returns and churn) of the cycles that can belong to a month.

    Only a buy-out moves a cycle's dates or looks at the entity's other cycles.  The few
    entities with a paid line take that way with all their cycles; for all others the
    dates are their own, and the scan is bounded by the months."""
    bought = paid_buyouts(L).select(F.col("b_entity_id").alias(ENTITY_KEYS[0]), F.col("b_entity_type").alias(ENTITY_KEYS[1])).distinct()
    moved = lifecycle_context(buyout_in_cycle(labelling_cycles(L, policy, entity_id).join(bought, ENTITY_KEYS, "left_semi"), L))
    own = labelling_cycles(L, policy, entity_id, in_months=True).join(bought, ENTITY_KEYS, "left_anti").withColumns({
        "rent_to_purchase_item_id": F.lit(None).cast("long"), "rtp_created_at_ist": F.lit(None).cast("date"), "has_rtp_in_window": F.lit(False),
        "global_tto_date": F.lit(None).cast("date"), "future_cycles_count": F.lit(0).cast("long"),
        "synthetic_recognised_at_ist": F.col("recognised_at_ist"), "used_tto_date_for_pattern": F.lit(False),
    })
    return moved.unionByName(own)


def cycle_month_class(df: DataFrame, months: DataFrame) -> DataFrame:
    """Every (cycle, analysis month, class) the cycle matches, classes
    CURRENT_MTP / MTP / NORMAL_CYCLE on the buy-out adjusted date (month
    ends half-open)."""
    start, end, syn = F.col("cycle_start_date"), F.col("cycle_end_date"), F.col("synthetic_recognised_at_ist")
    k11 = F.add_months(F.trunc(start, "month"), 1)
    k12 = F.add_months(F.trunc(syn, "month"), 1)
    kcm = F.trunc(syn, "month")
    kcm_next = F.add_months(kcm, 1)
    s11 = syn.isNull() | (syn >= F.trunc(start, "month"))
    s12 = start >= k12
    cm = (start >= kcm_next) | ((start < kcm_next) & (syn < end))
    tags = F.array(
        F.when(s11, F.struct(F.lit("NORMAL_CYCLE").alias("mtp_classification"), k11.alias("_m"))),
        F.when(s12, F.struct(F.lit("MTP").alias("mtp_classification"), k12.alias("_m"))),
        F.when(cm, F.struct(F.lit("CURRENT_MTP").alias("mtp_classification"), kcm.alias("_m"))),
    )
    m = F.broadcast(months.select("month_num", F.col("m_start").alias("_m"), F.col("m_label").alias("matched_month_window")))
    return (
        df.select("*", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t"))
        .select("*", "t.mtp_classification", "t._m")
        .drop("t")
        .join(m, "_m")
        .drop("_m")
    )


def class_rank() -> F.Column:
    expr = None
    for name, rank in CLASS_RANK.items():
        expr = F.when(F.col("mtp_classification") == name, rank) if expr is None else expr.when(
            F.col("mtp_classification") == name, rank
        )
    return expr


def earliest_match(df: DataFrame) -> DataFrame:
    """One row per (entity, cycle dates): the earliest matching month,
    its strongest class, then value columns as tie-breakers."""
    w = Window.partitionBy(*CYCLE).orderBy(
        F.col("month_num").asc(),
        class_rank().asc(),
        F.col("recognised_at_ist").asc_nulls_first(),
        F.col("cycle_taxable_amount").asc_nulls_first(),
        F.col("recognition_type").asc_nulls_first(),
        F.col("return_item_id").asc_nulls_first(),
        F.col("rent_to_purchase_item_id").asc_nulls_first(),
        F.col("rtp_created_at_ist").asc_nulls_first(),
        F.col("churn_classification").asc_nulls_first(),
    )
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def cycle_label(df: DataFrame) -> DataFrame:
    """TTO accelerator > TTO full > TTO partial > current MTP > MTP >
    churn full > churn partial > normal."""
    rtp, ret, fut = F.col("has_rtp_in_window"), F.col("has_return_in_window"), F.col("future_cycles_count")
    churn, cls = F.col("churn_classification"), F.col("mtp_classification")
    label = (
        F.when(rtp & (fut > 0), "TTO_MTP_ACCELERATOR")
        .when(rtp & (fut == 0) & (churn == "FULL"), "TTO_FULL")
        .when(rtp & (fut == 0) & (churn == "PARTIAL"), "TTO_PARTIAL")
        .when(cls == "CURRENT_MTP", "CURRENT_MTP")
        .when(cls == "MTP", "MTP")
        .when(ret & (churn == "FULL"), "CHURN_FULL")
        .when(ret & (churn == "PARTIAL"), "CHURN_PARTIAL")
        .otherwise("NORMAL_CYCLE")
    )
    return df.withColumn("primary_cycle_type", label)


def cycle_label_terminal(df: DataFrame) -> DataFrame:
    """L07T: the older label set with a single terminal buy-out label."""
    rtp, ret, fut = F.col("has_rtp_in_window"), F.col("has_return_in_window"), F.col("future_cycles_count")
    churn, cls = F.col("churn_classification"), F.col("mtp_classification")
    label = (
        F.when(rtp & (fut > 0), "TTO_MTP_ACCELERATOR")
        .when(rtp & (fut == 0), "TTO_CHURN_TERMINAL")
        .when(cls == "CURRENT_MTP", "CURRENT_MTP")
        .when(cls == "MTP", "MTP")
        .when(ret & (churn == "FULL"), "CHURN_FULL")
        .when(ret & (churn == "PARTIAL"), "CHURN_PARTIAL")
        .otherwise("NORMAL_CYCLE")
    )
    return df.withColumn("primary_cycle_type", label)


def entity_context(L: Ledger) -> DataFrame:
    """User, order, IST activation date and name of every entity."""
    cols = ["id", "user_id", "order_id", ist_date("activation_date").alias("item_activation_date"), F.col("name").alias("item_name")]
    return L.items.select(*cols, F.lit("ITEM").alias("entity_type")).unionByName(
        L.attachments.select(*cols, F.lit("ATTACHMENT").alias("entity_type"))
    ).select(
        F.col("id").alias("accountable_entity_id"), F.col("entity_type").alias("accountable_entity_type"),
        "user_id", "order_id", "item_activation_date", "item_name",
    )


def lifecycle_pattern(df: DataFrame) -> DataFrame:
    """Last cycle end, EARLY_RECOGNITION (no normal cycle at all) vs
    NORMAL_LIFECYCLE, churn inside/outside the recognition month, and the
    cycle's position counted from the end."""
    w = Window.partitionBy(*ENTITY_KEYS)
    last_end = F.max("cycle_end_date").over(w)
    any_normal = F.max(F.when(F.col("mtp_classification") == "NORMAL_CYCLE", 1).otherwise(0)).over(w)
    any_class = F.max(F.when(F.col("mtp_classification").isNotNull(), 1).otherwise(0)).over(w)
    rec_month = F.trunc("synthetic_recognised_at_ist", "month")
    pos = F.row_number().over(
        Window.partitionBy(*ENTITY_KEYS).orderBy(F.col("cycle_end_date").desc(), F.col("cycle_start_date").desc())
    )
    return df.select(
        "*",
        last_end.alias("last_cycle_end_date"),
        F.when((any_normal == 0) & (any_class == 1), "EARLY_RECOGNITION").otherwise("NORMAL_LIFECYCLE").alias(
            "item_recognition_pattern"
        ),
        F.when(
            F.col("has_return_in_window") & (last_end >= rec_month) & (last_end <= F.add_months(rec_month, 1)),
            "CHURN_IN_RECOGNITION_MONTH",
        ).otherwise("CHURN_OUTSIDE_MONTH").alias("churn_pattern_type"),
        pos.alias("cycle_position_from_end"),
    ).withColumn("is_item_last_cycle", F.col("cycle_position_from_end") == 1)


def labelling_pipeline(L: Ledger, policy: Policy, months: DataFrame, tagged: DataFrame | None, entity_id=None,
                       terminal: bool = False, stage=lambda df: df, churn_table: DataFrame | None = None) -> dict[str, DataFrame]:
    """L01-L04 over every cycle, and L05-L10 over the analysis months, each built when asked for.

    The months are cut out early, for most entities in the scan (`month_context`):
    buy-out context and month class need only the cycles and their buy-outs, so returns and churn flags join the few cycles
    that match a month.  (Joins commute here: each adds its own columns by
    entity, and the class does not depend on returns or churn.)  Whether later
    cycles exist is all that the labels ask of `future_cycles_count`.

    With `churn_table` the flags come from a published churn table, and only cycles that
    hold a return get one; `tagged` is not read.
    """
    returns_only = churn_table is not None
    flags = published_churn_flags(churn_table) if returns_only else entity_churn_flags(tagged, L)
    candidates = lambda: stage(cycle_month_class(month_context(L, policy, entity_id), months))
    f = Frames({
        "L01": lambda: return_in_cycle(labelling_cycles(L, policy, entity_id), L),
        "L02": lambda: buyout_in_cycle(f["L01"], L),
        "L03": lambda: churn_enrichment(f["L02"], flags, returns_only),
        "L04": lambda: lifecycle_context(f["L03"]),
        "L05": lambda: churn_enrichment(return_in_cycle(candidates(), L), flags, returns_only),
        "L06": lambda: stage(earliest_match(f["L05"])),
        "L07": lambda: (cycle_label_terminal if terminal else cycle_label)(f["L06"]),
        "L07T": lambda: cycle_label_terminal(f["L06"]),
        "L08": lambda: entity_context(L),
        "L09": lambda: lifecycle_pattern(f["L07"].join(f["L08"], ENTITY_KEYS, "left")),
        "L10": lambda: f["L09"],
    })
    return f


HISTORY_COLUMNS = [
    "user_id", "order_id", "item_activation_date", "item_name", "cycle_start_date", "cycle_end_date", "recognised_at",
    "recognised_at_ist", "synthetic_recognised_at_ist", "used_tto_date_for_pattern", "recognition_type",
    "cycle_taxable_amount", "has_return_in_window", "return_item_id", "return_item_state", "return_created_at_ist",
    "has_rtp_in_window", "rent_to_purchase_item_id", "rtp_created_at_ist", "churn_classification",
    "churn_transaction_type", "mtp_classification", "matched_month_window", "primary_cycle_type",
    "last_cycle_end_date", "item_recognition_pattern", "churn_pattern_type", "is_item_last_cycle",
    "cycle_position_from_end",
]


def cycle_history(l09: DataFrame, policy: Policy) -> DataFrame:
    """The labelled cycle history, one row per cycle of the months; the
    as-of date stands for the time of extraction."""
    return l09.select(
        F.col("accountable_entity_id").alias("entity_id"), F.col("accountable_entity_type").alias("entity_type"),
        *HISTORY_COLUMNS,
        F.col("mtp_classification").alias("mtp_classification_synthetic"),
        F.lit(policy.as_of).cast("date").alias("extracted_at"),
    )
