"""Add-on service (VAS) revenue: by category (R24-R27), the timing audit
(R28), the month-over-month VAS bridge (R29) and VAS-adjusted opening (R30)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.functions import money
from revbridge.policy import Policy
from revbridge.sources.ledger import Ledger


def _category(type_col: F.Column, policy: Policy) -> F.Column:
    expr = F.lit("R27")
    for name, comp in reversed(policy.vas_types):
        expr = F.when((type_col == name) | type_col.endswith("_" + name), comp).otherwise(expr)
    return expr


def vas_owners(L: Ledger, directory: DataFrame) -> DataFrame:
    """Live add-on services with the user of the entity they belong to."""
    d = directory.select(F.col("id").alias("entity_id"), "entity_type", "user_id")
    return (
        L.vas.filter(F.col("state") != "CANCELLED")
        .join(d, ["entity_id", "entity_type"])
        .select(F.col("id").alias("accountable_entity_id"), F.col("type").alias("vas_type"), "user_id")
    )


def vas_revenue_rows(vas_cycles: DataFrame, owners: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """Add-on cycles starting in the month, by category."""
    m = F.broadcast(months.select("month_num", F.col("m_start").alias("_m")))
    j = (
        vas_cycles.withColumn("_m", F.trunc(F.to_date("rr_start_date"), "month"))
        .join(m, "_m")
        .join(owners, "accountable_entity_id", "left")
    )
    return j.select(
        "month_num",
        _category(F.col("vas_type"), policy).alias("component"),
        F.lit("VALUE_ADDED_SERVICE").alias("entity_type"),
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"),
        money("taxable_amount").alias("amount"),
    )


def vas_timing_detail(vas_cycles: DataFrame, owners: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """Add-on cycles tagged 'Current month VAS' / 'Previous month VAS'
    for each analysis month (a cycle can be both, for consecutive months)."""
    start = F.to_date("rr_start_date")
    tags = F.array(
        F.struct(F.lit("Current month VAS").alias("vas_timing"), F.trunc(start, "month").alias("_m")),
        F.struct(F.lit("Previous month VAS").alias("vas_timing"), F.add_months(F.trunc(start, "month"), 1).alias("_m")),
    )
    m = F.broadcast(months.select("month_num", F.col("m_start").alias("_m")))
    j = (
        vas_cycles.select("*", F.explode(tags).alias("t"))
        .select("*", "t.vas_timing", "t._m")
        .drop("t")
        .join(m, "_m")
        .join(owners, "accountable_entity_id", "left")
    )
    return j.select(
        "month_num", "accountable_entity_id", "external_reference_id",
        start.alias("start_date"), F.to_date("rr_end_date").alias("end_date"),
        money("taxable_amount").alias("taxable_amount"),
        "vas_type", "user_id",
        _category(F.col("vas_type"), policy).alias("vas_component"),
        "vas_timing",
    )


def vas_bridge(timing: DataFrame) -> DataFrame:
    """Per month, current-month minus previous-month add-on items,
    customers and revenue.  Counted per (month, timing) first, so no row is
    expanded for four conditional distinct counts."""
    g = timing.groupBy("month_num", "vas_timing").agg(
        F.count_distinct("accountable_entity_id").alias("items"),
        F.count_distinct("user_id").alias("cx"),
        F.sum("taxable_amount").alias("rev"),
    )
    sign = F.when(F.col("vas_timing") == "Current month VAS", 1).otherwise(-1)
    return g.groupBy("month_num").agg(
        F.sum(F.col("items") * sign).alias("vas_items"),
        F.sum(F.col("cx") * sign).alias("vas_cx"),
        F.sum(F.coalesce(F.col("rev"), F.lit(0)) * sign).cast("decimal(28,2)").alias("vas_rev"),
    )


def vas_adjusted_opening(adjusted: DataFrame, bridge: DataFrame) -> DataFrame:
    """Adjusted opening plus the VAS bridge of the month."""
    return adjusted.join(bridge, "month_num", "left").select(
        "month_num",
        (F.col("items_count") + F.coalesce("vas_items", F.lit(0))).alias("items_count"),
        (F.col("cx_count") + F.coalesce("vas_cx", F.lit(0))).alias("cx_count"),
        (F.col("taxable_revenue") + F.coalesce("vas_rev", F.lit(0))).cast("decimal(28,2)").alias("taxable_revenue"),
    )
