"""Discount products (D01-D06) and the discount components.

The discount list is schema-on-read JSON: parsed once with `from_json` and
exploded with `explode_outer`, so cycles without discounts are kept (with a
NULL line), as the ledger's LATERAL VIEW OUTER does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revbridge.functions import DISCOUNT_SCHEMA, money, tenure_months
from revbridge.operators.base import ENTITY_KEYS
from revbridge.operators.movements import LONG, bucket
from revbridge.policy import Policy
from revbridge.sources.ledger import Ledger


def discount_lines(entity_base: DataFrame) -> DataFrame:
    """One row per discount line of a cycle (NULL line when none)."""
    parsed = F.from_json(F.col("discounts").cast("string"), DISCOUNT_SCHEMA)
    return entity_base.select(
        *ENTITY_KEYS,
        "revenue_recognition_schedule_id",
        "external_reference_type",
        F.to_date("rr_start_date").alias("rr_start_date"),
        F.to_date("rr_end_date").alias("rr_end_date"),
        *[c for c in ("sched_tenure",) if c in entity_base.columns],
        F.explode_outer(parsed).alias("d"),
    ).select(
        "*",
        F.col("d.catalogReferenceId").alias("catalogReferenceId"),
        money(F.col("d.amount")).alias("discount_amount"),
    ).drop("d")


def catalog(L: Ledger) -> DataFrame:
    """Discount catalog keyed as the JSON references it (a string)."""
    return L.discounts.select(F.col("id").cast("string").alias("catalogReferenceId"), F.col("type").alias("discount_type"))


def discount_types(lines: DataFrame, L: Ledger) -> DataFrame:
    """Discount lines with their catalog type (NULL when not catalogued).

    Lines without a catalog id (cycles without discounts) match nothing; a second
    key deals them over all tasks, so that they do not meet on the NULL one and
    cycles are read and parsed once.  The join itself is left to AQE: broadcast
    only when its measured size is under the threshold."""
    ref = F.col("catalogReferenceId")
    spread = F.when(ref.isNull(), F.xxhash64(*ENTITY_KEYS, "revenue_recognition_schedule_id", "rr_start_date")).otherwise(0)
    known = catalog(L).withColumn("_spread", ref.isNull().cast("long"))  # 0 where an id can match
    return lines.withColumn("_spread", spread).join(known, ["catalogReferenceId", "_spread"], "left").drop("_spread")


CYCLE = [*ENTITY_KEYS, "revenue_recognition_schedule_id", "rr_start_date", "rr_end_date", "external_reference_type", "sched_tenure"]


def cycle_discounts(typed: DataFrame) -> DataFrame:
    """One row per cycle: lines and amounts of upfront and of other discounts
    (a cycle without discounts has one other line without an amount)."""
    up = F.coalesce(F.col("discount_type") == "UPFRONT", F.lit(False))
    amount = F.coalesce(F.col("discount_amount"), F.lit(0).cast("decimal(18,2)"))
    zero = F.lit(0).cast("decimal(18,2)")
    return typed.groupBy(*[c for c in CYCLE if c in typed.columns]).agg(
        F.count(F.when(up, 1)).alias("upfront_lines"),
        F.sum(F.when(up, amount).otherwise(zero)).alias("upfront_amount"),
        F.count(F.when(~up, 1)).alias("other_lines"),
        F.sum(F.when(up, zero).otherwise(amount)).alias("other_amount"),
    )


def _upfront_cycle(policy: Policy) -> F.Column:
    """Whether R16 and D05 have a row for the cycle."""
    settled = F.coalesce(F.col("external_reference_type") == "SETTLEMENT", F.lit(False)) & F.lit(policy.include_settlement)
    return F.lit(policy.plan_transition_dense) | (F.col("upfront_lines") > 0) | settled


def _other_cycle(policy: Policy) -> F.Column:
    """Whether R20-R23 have a row for the cycle."""
    return F.lit(policy.discount_population != "non_upfront") | (F.col("other_lines") > 0)


def recent_cycle_discounts(L: Ledger, policy: Policy, entity_cycles: DataFrame, stage=lambda df: df) -> DataFrame:
    """`cycle_discounts` of the cycles that the months' discount components count or
    compare with: all that start in `policy.discount_window`, and of their entities
    the cycles of the latest earlier start (for upfront and for other discounts).
    LAG over these rows finds the same previous row as over all history (with a
    look-back: as over the cycles that it reaches).

    All scans are bounded by the cycle's start.  Earlier cycles of other entities go
    before their discounts are read (`stage` cuts the entities off, so that the planner
    knows how many they are), discounts are summed per cycle, and schedules are joined
    last, by the rows that are left."""
    low, high = policy.discount_window
    start = F.col("rr_start_date")
    rows = lambda cycles: cycle_discounts(discount_types(discount_lines(cycles), L))
    if policy.discount_lookback is not None:
        entity_cycles = entity_cycles.filter(start >= F.lit(policy.discount_lookback))
    inside = entity_cycles.filter((start >= F.lit(low)) & (start < F.lit(high)))
    recent = rows(inside)
    entities = stage(inside.select(*ENTITY_KEYS).distinct())
    earlier = rows(entity_cycles.filter(start.isNull() | (start < F.lit(low))).join(entities, ENTITY_KEYS, "left_semi"))
    entity = Window.partitionBy(*ENTITY_KEYS)
    kinds = {"_upfront": _upfront_cycle(policy), "_other": _other_cycle(policy)}
    earlier = earlier.withColumns(kinds)
    last = {k: F.max(F.when(F.col(k), start)).over(entity) for k in kinds}
    latest = earlier.withColumns({f"{k}_last": c for k, c in last.items()})
    latest = latest.filter(
        (F.col("_upfront") & start.eqNullSafe(F.col("_upfront_last"))) | (F.col("_other") & start.eqNullSafe(F.col("_other_last")))
    ).select(recent.columns)
    tenures = L.schedules.select(
        F.col("id").alias("revenue_recognition_schedule_id"), tenure_months("start_date", "end_date", policy.tenure_days_per_month).alias("sched_tenure")
    )
    return recent.unionByName(latest).join(tenures, "revenue_recognition_schedule_id", "left")


def entities_in(df: DataFrame, date_col: F.Column, months: DataFrame) -> DataFrame:
    """All rows of the entities that have a row dated in an analysis month (what
    a LAG over their history needs, and no more)."""
    return df.join(bucket(df.select(*ENTITY_KEYS, date_col.alias("_d")), "_d", months).select(*ENTITY_KEYS).distinct(), ENTITY_KEYS, "left_semi")


def upfront_per_schedule(typed: DataFrame, entity_id=None) -> DataFrame:
    """Upfront discount per (entity, schedule), settlement cycles out."""
    df = typed.filter((F.col("discount_type") == "UPFRONT") & (F.col("external_reference_type") != "SETTLEMENT"))
    if entity_id is not None:
        df = df.filter(F.col("accountable_entity_id") == entity_id)
    return df.groupBy(*ENTITY_KEYS, "revenue_recognition_schedule_id").agg(
        F.sum(F.coalesce(F.col("discount_amount"), F.lit(0))).cast("decimal(18,2)").alias("upfront_discount_amount")
    )


def discount_per_schedule(typed: DataFrame, entity_id=None) -> DataFrame:
    """All catalogued discounts per (entity, schedule), settlement out.
    Runs on the whole ledger; `entity_id` narrows it to one entity."""
    df = typed.filter(F.col("discount_type").isNotNull() & (F.col("external_reference_type") != "SETTLEMENT"))
    if entity_id is not None:
        df = df.filter(F.col("accountable_entity_id") == entity_id)
    return df.groupBy(*ENTITY_KEYS, "revenue_recognition_schedule_id").agg(
        F.sum(F.coalesce(F.col("discount_amount"), F.lit(0))).cast("decimal(18,2)").alias("discount_amount")
    )


def upfront_per_cycle(cycles: DataFrame, policy: Policy, keep_end: bool) -> DataFrame:
    """Upfront (or settlement) discount per cycle grain, from `cycle_discounts`.

    R16 does not tell cycles apart by their end; D05 does (`keep_end`).
    Default: only cycles carrying an upfront line (or settlement cycles) keep
    a row, so LAG compares with the previous *upfront* cycle.  With
    `plan_transition_dense` every cycle keeps a row (0 when none)."""
    settled = F.coalesce(F.col("external_reference_type") == "SETTLEMENT", F.lit(False)) & F.lit(policy.include_settlement)
    df = cycles.filter(_upfront_cycle(policy))
    amount = F.when(settled, F.col("upfront_amount") + F.col("other_amount")).otherwise(F.col("upfront_amount"))
    return df.groupBy(
        *ENTITY_KEYS, "revenue_recognition_schedule_id", F.col("rr_start_date").alias("start_date"),
        *(["rr_end_date"] if keep_end else []), "external_reference_type", F.col("sched_tenure").alias("tenure"),
    ).agg(F.sum(amount).cast("decimal(18,2)").alias("upfront_discount_amount"))


def _lagged(df: DataFrame, columns: list[str]) -> DataFrame:
    """Previous values in the order of start; the other columns break ties."""
    w = Window.partitionBy(*ENTITY_KEYS).orderBy(
        "start_date", "revenue_recognition_schedule_id", "external_reference_type", "tenure", "upfront_discount_amount"
    )
    lagged = df.select("*", *[F.lag(c).over(w).alias(f"previous_{c.removeprefix('rr_')}") for c in columns])
    return lagged.filter(F.col("previous_tenure").isNotNull() & (F.col("previous_tenure") != F.col("tenure")))


def plan_transition_rows(cycles: DataFrame, directory: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """Previous minus current upfront discount where the tenure changed,
    counted in the month after the cycle starts (the reference's bucket)."""
    grain = entities_in(upfront_per_cycle(cycles, policy, keep_end=False), F.add_months(F.col("start_date"), 1), months)
    lagged = bucket(_lagged(grain, ["tenure", "upfront_discount_amount"]), F.add_months(F.col("start_date"), 1), months)
    return _with_users(lagged, directory).select(
        "month_num",
        F.lit("R16").alias("component"),
        F.col("accountable_entity_type").alias("entity_type"),
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"),
        (F.coalesce(F.col("previous_upfront_discount_amount"), F.lit(0)) - F.coalesce(F.col("upfront_discount_amount"), F.lit(0)))
        .cast("decimal(18,2)")
        .alias("amount"),
    )


def plan_transition_detail(cycles: DataFrame, months: DataFrame, policy: Policy, entity_id=None, entity_type=None) -> DataFrame:
    """Every plan transition with delta = current - previous upfront
    discount (opposite sign to R16), for the whole ledger or one entity."""
    df = upfront_per_cycle(cycles, policy, keep_end=True)
    if entity_id is not None:
        df = df.filter(F.col("accountable_entity_id") == entity_id)
    if entity_type is not None:
        df = df.filter(F.col("accountable_entity_type") == entity_type)
    df = entities_in(df, F.add_months(F.col("start_date"), 1), months)
    lagged = _lagged(df, ["tenure", "upfront_discount_amount", "start_date", "rr_end_date"])
    return bucket(lagged, F.add_months(F.col("start_date"), 1), months).select(
        "month_num", *ENTITY_KEYS, "revenue_recognition_schedule_id", "start_date",
        F.col("rr_end_date").alias("end_date"), "tenure", "upfront_discount_amount", "previous_tenure",
        "previous_upfront_discount_amount", "previous_start_date", "previous_end_date",
        (F.coalesce(F.col("upfront_discount_amount"), F.lit(0)) - F.coalesce(F.col("previous_upfront_discount_amount"), F.lit(0)))
        .cast("decimal(18,2)")
        .alias("discount_change"),
    )


def discount_grain_check(entity_base: DataFrame) -> DataFrame:
    """The exploded discount lines add up to the JSON total of each
    cycle group (entity, schedule, dates, discount text).

    One pass: each cycle contributes its JSON total on its first exploded
    line (position 0, or the NULL line of an empty list) and every line
    contributes its own amount, so no join back is needed.  Hardly two cycles
    share a group: they are dealt by group before their lines are taken apart,
    over all tasks of a shuffle, so none holds the groups of all the rows it has scanned."""
    zero = F.lit(0).cast("decimal(18,2)")
    row_total = F.aggregate(
        "parsed", zero, lambda acc, x: (acc + F.coalesce(money(x["amount"]), zero)).cast("decimal(18,2)")
    )
    key = [*ENTITY_KEYS, "revenue_recognition_schedule_id", "rr_start_date", "rr_end_date", "discounts"]
    tasks = int(entity_base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cycles = entity_base.select(*key).repartition(tasks, *key)
    lines = cycles.withColumn("parsed", F.from_json(F.col("discounts").cast("string"), DISCOUNT_SCHEMA)).select(
        *key, F.coalesce(row_total, zero).alias("row_total"), F.posexplode_outer("parsed").alias("pos", "d")
    )
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    g = lines.groupBy(*key).agg(
        F.count(F.when(first, F.lit(1))).alias("n_cycles"),
        F.sum(F.when(first, F.col("row_total")).otherwise(zero)).cast("decimal(18,2)").alias("json_total"),
        F.sum(F.coalesce(money(F.col("d.amount")), zero)).cast("decimal(18,2)").alias("exploded_total"),
    )
    return g.select(
        *ENTITY_KEYS, "revenue_recognition_schedule_id",
        F.to_date("rr_start_date").alias("start_date"), "n_cycles", "json_total", "exploded_total",
        (F.col("json_total") == F.col("exploded_total")).alias("matches"),
    )


def discount_per_cycle(cycles: DataFrame, policy: Policy) -> DataFrame:
    """The discounts that R20-R23 compare, per cycle dates."""
    df, amount = cycles.filter(_other_cycle(policy)), F.col("other_amount")
    if policy.discount_population != "non_upfront":
        amount = amount + F.col("upfront_amount")
    return df.groupBy(*ENTITY_KEYS, F.col("rr_start_date").alias("start_date"), F.col("rr_end_date").alias("end_date")).agg(
        F.sum(amount).cast("decimal(18,2)").alias("total_discount_amount")
    )


def _with_users(df: DataFrame, directory: DataFrame) -> DataFrame:
    users = directory.select(
        F.col("id").alias("accountable_entity_id"), F.col("entity_type").alias("accountable_entity_type"), "user_id"
    )
    return df.join(users, ENTITY_KEYS, "left")


def discount_given_rows(per_cycle: DataFrame, directory: DataFrame, months: DataFrame) -> DataFrame:
    """Discount of cycles starting in the month."""
    return _with_users(bucket(per_cycle, "start_date", months), directory).select(
        "month_num", F.lit("R20").alias("component"),
        F.col("accountable_entity_type").alias("entity_type"), F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"), F.col("total_discount_amount").alias("amount"),
    )


def discount_change_rows(per_cycle: DataFrame, directory: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """Previous minus current discount where it changed, counted
    `discount_change_months` after the cycle starts; R22 / R23 keep positive /
    negative."""
    when = F.add_months(F.col("start_date"), policy.discount_change_months)
    w = Window.partitionBy(*ENTITY_KEYS).orderBy("start_date", "end_date")
    lagged = entities_in(per_cycle, when, months).select(
        "*", F.lag("total_discount_amount").over(w).alias("previous_discount_amount")
    ).filter(
        F.col("previous_discount_amount").isNotNull()
        & (F.col("previous_discount_amount") != F.col("total_discount_amount"))
    )
    diff = (F.col("previous_discount_amount") - F.col("total_discount_amount")).cast("decimal(18,2)")
    rows = _with_users(bucket(lagged, when, months), directory).select(
        "month_num",
        F.col("accountable_entity_type").alias("entity_type"), F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"), diff.alias("amount"),
    )
    tags = F.array(
        F.lit("R21"),
        F.when(F.col("amount") > 0, F.lit("R22")),
        F.when(F.col("amount") < 0, F.lit("R23")),
    )
    return rows.select("*", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("component")).select(*LONG)
