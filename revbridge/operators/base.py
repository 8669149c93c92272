"""Base layer (B01-B11): the cycle-level frames every product starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.functions import ist_date, is_paid, money, tenure_months
from revbridge.policy import EXCLUDED_RR_STATES, Policy
from revbridge.sources.ledger import Ledger

ENTITY_KEYS = ["accountable_entity_id", "accountable_entity_type"]


def entity_directory(L: Ledger) -> DataFrame:
    """Non-cancelled items and attachments with their user."""
    def side(df: DataFrame, kind: str) -> DataFrame:
        return df.filter(F.col("state") != "CANCELLED").select(
            "id", F.lit(kind).alias("entity_type"), "user_id"
        )

    return side(L.items, "ITEM").unionByName(side(L.attachments, "ATTACHMENT"))


def ledger_base(L: Ledger, policy: Policy, with_schedule: bool = True) -> DataFrame:
    """Live cycles of the vertical joined to their schedule.

    The vertical/state predicates reach the parquet scan; the schedule join is
    a plain equi-join that Spark plans as sort-merge (or broadcast when the
    schedule side is small enough).  Consumers that read no schedule column
    use `with_schedule=False` and skip the join entirely.
    """
    rr = L.recognitions.filter(
        (F.col("vertical") == policy.vertical) & ~F.col("state").isin(*EXCLUDED_RR_STATES)
    )
    if policy.exclude_deleted:
        rr = rr.filter(F.col("deleted_at").isNull())
    if policy.created_from is not None:
        lower = F.lit(policy.created_from).cast("date")
        rr = rr.filter((F.col("created_at") >= lower) & (F.col("start_date") >= lower))
    cols = [
        "recognition_type",
        *ENTITY_KEYS,
        F.col("start_date").alias("rr_start_date"),
        F.col("end_date").alias("rr_end_date"),
        "recognised_at",
        "created_at",
        ist_date("recognised_at").alias("recognised_at_ist"),
        ist_date("created_at").alias("created_at_ist"),
        "external_reference_type",
        "external_reference_id",
        "revenue_recognition_schedule_id",
        money("taxable_amount").alias("taxable_amount"),
        "discounts",
    ]
    if not with_schedule:
        return rr.select(*cols)
    s = L.schedules.select(
        F.col("id").alias("revenue_recognition_schedule_id"),
        F.col("start_date").alias("sched_start_date"),
        F.col("end_date").alias("sched_end_date"),
        F.col("taxable_amount").alias("sched_taxable_amount"),
        F.col("post_tax_amount").alias("sched_post_tax_amount"),
    )
    return rr.join(s, "revenue_recognition_schedule_id", "left").select(
        *cols,
        "sched_taxable_amount",
        "sched_post_tax_amount",
        "sched_start_date",
        "sched_end_date",
        tenure_months("sched_start_date", "sched_end_date", policy.tenure_days_per_month).alias("sched_tenure"),
    )


def ledger_split(base: DataFrame) -> dict[str, DataFrame]:
    """Entity / penalty / add-on slices of one base frame."""
    t = F.col("accountable_entity_type")
    return {
        "entity": base.filter(t.isin("ITEM", "ATTACHMENT")),
        "penalty": base.filter(t == "PENALTY"),
        "vas": base.filter(t == "VALUE_ADDED_SERVICE"),
    }


def _with_user(df: DataFrame, directory: DataFrame) -> DataFrame:
    d = directory.select(
        F.col("id").alias("accountable_entity_id"),
        F.col("entity_type").alias("accountable_entity_type"),
        "user_id",
    )
    return df.join(d, ENTITY_KEYS, "left")


def revenue_cycles(L: Ledger, policy: Policy, base: DataFrame | None = None) -> DataFrame:
    """Entity cycles with business dates and the owning user."""
    base = base if base is not None else ledger_base(L, policy)
    ent = ledger_split(base)["entity"]
    return _with_user(
        ent.select(
            *ENTITY_KEYS,
            F.to_date("rr_start_date").alias("start_date"),
            F.to_date("rr_end_date").alias("end_date"),
            F.col("recognised_at_ist").alias("recognised_at"),
            "taxable_amount",
            "recognition_type",
        ),
        entity_directory(L),
    )


def buyout_dates(L: Ledger) -> DataFrame:
    """Latest paid, non-cancelled buy-out date (IST) per entity."""
    orders = L.rtp_orders.filter(F.col("state") != "CANCELLED").select(
        F.col("id").alias("rent_to_purchase_order_id"), "created_at"
    )

    def side(df: DataFrame, id_col: str, kind: str) -> DataFrame:
        return (
            df.filter(is_paid("payment_details"))
            .join(orders, "rent_to_purchase_order_id")
            .groupBy(F.col(id_col).alias("accountable_entity_id"))
            .agg(ist_date(F.max("created_at")).alias("tto_date"))
            .withColumn("accountable_entity_type", F.lit(kind))
        )

    return side(L.rtp_items, "item_id", "ITEM").unionByName(
        side(L.rtp_attachments, "attachment_id", "ATTACHMENT")
    )


def effective_recognition_date(cycles: DataFrame, buyouts: DataFrame) -> DataFrame:
    """Recognition date pulled back to the buy-out date when the cycle
    starts, or was recognised, after the buy-out."""
    j = cycles.join(buyouts, ENTITY_KEYS, "left")
    return j.withColumn(
        "synthetic_recognised_at",
        F.when(F.col("start_date") > F.col("tto_date"), F.col("tto_date"))
        .when(
            (F.col("recognised_at") > F.col("tto_date")) & F.col("tto_date").isNotNull(),
            F.col("tto_date"),
        )
        .otherwise(F.col("recognised_at")),
    )


_FIRST = ["created_at", "recognition_type", "external_reference_type"]


def _grain_columns() -> list[F.Column]:
    return [
        F.col("first.recognition_type").alias("revenue_recognition_type"),
        *[F.col(k) for k in ENTITY_KEYS],
        F.col("revenue_recognition_schedule_id"),
        F.to_date("sched_start_date").alias("start_date"),
        F.to_date("sched_end_date").alias("end_date"),
        F.round(F.try_divide(F.col("sched_taxable_amount"), F.nullif(F.col("sched_tenure"), F.lit(0))), 2)
        .cast("decimal(18,2)")
        .alias("taxable_amount"),
        F.col("sched_tenure").alias("tenure"),
        F.col("first.external_reference_type").alias("external_reference_type"),
        ist_date(F.col("first.created_at")).alias("created_at"),
    ]


def schedule_grain(entity_base: DataFrame) -> DataFrame:
    """The earliest-created cycle of each (entity, schedule).

    Written as a grouped min over a struct instead of ROW_NUMBER()=1: the
    aggregate combines map-side, so a hot entity never lands in one sort.
    Ties on created_at are broken on the remaining value columns.
    """
    g = entity_base.groupBy(
        *ENTITY_KEYS,
        "revenue_recognition_schedule_id",
        "sched_start_date",
        "sched_end_date",
        "sched_taxable_amount",
        "sched_tenure",
    ).agg(F.min(F.struct(*_FIRST)).alias("first"))
    return g.select(*_grain_columns())


def recent_grain(L: Ledger, policy: Policy, entity_cycles: DataFrame, stage=None) -> DataFrame:
    """B09 of the schedules that start in the months, and of their entities the one
    before (by start, creation and id; none has no start): what R16P-R19 compare.

    Only entities with a cycle of a schedule that starts in the months have rows: where
    `stage` can cut off these two short lists (so that the planner knows their size), the
    cycles of other entities go first.  The rest is reduced to one row per (entity,
    schedule) map-side before the schedules are joined; the schedule before is a grouped `max_by`, so neither a sort nor a
    window sees the history.  The cycles' scan has no bound: the type of a schedule is
    that of its earliest-created cycle, whenever that starts."""
    if stage is not None:
        started = (F.to_date("start_date") >= F.lit(policy.first_start)) & (F.to_date("start_date") < F.lit(policy.last_next))
        ids = stage(L.schedules.filter(started).select(F.col("id").alias("revenue_recognition_schedule_id")).distinct())
        of_months = entity_cycles.join(ids, "revenue_recognition_schedule_id", "left_semi")
        entities = stage(of_months.select(F.col(ENTITY_KEYS[0]).alias("_id"), F.col(ENTITY_KEYS[1]).alias("_type")).distinct())
        same = F.col(ENTITY_KEYS[0]).eqNullSafe(F.col("_id")) & F.col(ENTITY_KEYS[1]).eqNullSafe(F.col("_type"))
        entity_cycles = entity_cycles.join(entities, same, "left_semi")
    firsts = entity_cycles.groupBy(*ENTITY_KEYS, "revenue_recognition_schedule_id").agg(F.min(F.struct(*_FIRST)).alias("first"))
    s = L.schedules.select(
        F.col("id").alias("revenue_recognition_schedule_id"),
        F.col("start_date").alias("sched_start_date"),
        F.col("end_date").alias("sched_end_date"),
        F.col("taxable_amount").alias("sched_taxable_amount"),
        tenure_months("start_date", "end_date", policy.tenure_days_per_month).alias("sched_tenure"),
    )
    grain = firsts.join(s, "revenue_recognition_schedule_id", "left").select(*_grain_columns())
    start = F.col("start_date")
    rest = [c for c in grain.columns if c not in ENTITY_KEYS]
    row = F.struct(*rest)
    inside = (start >= F.lit(policy.first_start)) & (start < F.lit(policy.last_next))
    before = start.isNull() | (start < F.lit(policy.first_start))
    place = F.struct("start_date", "created_at", "revenue_recognition_schedule_id")
    per_entity = grain.filter(before | inside).groupBy(*ENTITY_KEYS).agg(
        F.collect_list(F.when(inside, row)).alias("_in"), F.max_by(F.when(before, row), F.when(before, place)).alias("_last")
    )
    rows = F.concat(F.filter(F.array("_last"), lambda r: r.isNotNull()), F.col("_in"))
    return per_entity.filter(F.size("_in") > 0).select(*ENTITY_KEYS, F.explode(rows).alias("r")).select(*ENTITY_KEYS, "r.*").select(grain.columns)


def first_completed_return(L: Ledger) -> DataFrame:
    """Earliest COMPLETED return per item and per attachment."""
    def side(df: DataFrame, id_col: str, kind: str) -> DataFrame:
        return (
            df.filter(F.col("state") == "COMPLETED")
            .groupBy(F.col(id_col).alias("accountable_entity_id"))
            .agg(F.min("created_at").alias("return_created_at"))
            .withColumn("accountable_entity_type", F.lit(kind))
        )

    return side(L.return_items, "item_id", "ITEM").unionByName(
        side(L.return_attachments, "attachment_id", "ATTACHMENT")
    )


def normalised_cycles(L: Ledger, policy: Policy, base: DataFrame | None = None) -> DataFrame:
    """Cycles with monthly taxable / post-tax rates, the entity's first
    cycle start and its first completed return (IST date)."""
    base = base if base is not None else ledger_base(L, policy)
    ent = ledger_split(base)["entity"]
    tenure = F.nullif(F.col("sched_tenure"), F.lit(0))
    cyc = ent.select(
        *ENTITY_KEYS,
        "recognition_type",
        F.to_date("rr_start_date").alias("start_date"),
        F.to_date("rr_end_date").alias("end_date"),
        F.round(F.try_divide(F.col("sched_taxable_amount"), tenure), 2).cast("decimal(18,2)").alias("monthly_taxable_amount"),
        F.round(F.try_divide(F.col("sched_post_tax_amount"), tenure), 2).cast("decimal(18,2)").alias("monthly_post_tax_amount"),
        F.col("sched_tenure").alias("tenure"),
        F.col("recognised_at_ist").alias("recognised_at"),
        F.col("created_at_ist").alias("created_at"),
        "external_reference_type",
        "external_reference_id",
        "revenue_recognition_schedule_id",
        "taxable_amount",
    )
    # entity-wide MIN(start) as a grouped aggregate joined back (no window sort)
    first_start = cyc.groupBy(*ENTITY_KEYS).agg(F.min("start_date").alias("min_start_date"))
    returns = first_completed_return(L).select(
        *ENTITY_KEYS, ist_date("return_created_at").alias("return_created_at")
    )
    return _with_user(cyc, entity_directory(L)).join(first_start, ENTITY_KEYS).join(
        returns, ENTITY_KEYS, "left"
    )
