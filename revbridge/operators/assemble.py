"""Aggregation and report assembly.

All components arrive as entity-level rows in one long schema; one
`groupBy(month_num, component)` turns them into items / customers / revenue.
Distinct counts are planned by Spark as a two-level aggregate on
(group, value), so a month holding most rows is still combined map-side.
Everything after that aggregate is months x components sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revbridge.operators.vas import vas_adjusted_opening
from revbridge.policy import (
    ADJUSTED_OPENING,
    CLOSING_CUSTOMERS,
    CLOSING_ITEMS,
    CLOSING_REVENUE,
    COMPONENTS,
    EXTRA_COMPONENTS,
    FAMILIES,
    GAP,
    TOTAL_CLOSING,
)


def _zero() -> F.Column:
    return F.lit(0).cast("decimal(18,2)")


def component_table(spark: SparkSession, labels: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """One row per component; `labels` replaces some of the fixed labels."""
    fam, own = {c: f for f, members in FAMILIES.items() for c in members}, dict(labels)
    rows = [
        (cid, own.get(cid, label), order, sign, cx, fam.get(cid))
        for cid, label, order, sign, cx in COMPONENTS + EXTRA_COMPONENTS
    ]
    return spark.createDataFrame(
        rows, "component string, label string, sort_order int, sign int, counts_customers boolean, family string"
    )


def component_rule(labels: tuple[tuple[str, str], ...] = ()) -> F.Column:
    """What the report knows of the row's component, from a literal map (no join)."""
    fam, own = {c: f for f, members in FAMILIES.items() for c in members}, dict(labels)
    entries = []
    for cid, label, order, sign, cx in COMPONENTS + EXTRA_COMPONENTS:
        entries += [F.lit(cid), F.struct(
            F.lit(own.get(cid, label)).alias("label"), F.lit(order).alias("sort_order"), F.lit(sign).alias("sign"),
            F.lit(cx).alias("counts_customers"), F.lit(fam.get(cid)).cast("string").alias("family"),
        )]
    return F.create_map(*entries)[F.col("component")]


def aggregate_components(rows: DataFrame, labels: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Items (distinct entity), customers (distinct customer) and revenue per
    (month, component), with the component's sign and customer rule applied."""
    g = rows.groupBy("month_num", "component").agg(
        F.count_distinct("entity_type", "entity_id").alias("items"),
        F.count_distinct("customer").alias("cx"),
        F.sum("amount").alias("rev"),
    )
    return g.withColumn("m", component_rule(labels)).select(
        "month_num", "component", "m.label", "m.sort_order", "m.family",
        (F.col("items") * F.col("m.sign")).cast("long").alias("items_count"),
        F.when(F.col("m.counts_customers"), F.col("cx") * F.col("m.sign")).otherwise(F.lit(0)).cast("long").alias("cx_count"),
        (F.col("rev") * F.col("m.sign")).cast("decimal(28,2)").alias("taxable_revenue"),
    )


def all_components(agg: DataFrame, labels: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Long report rows.  A component of a shared frame (opening,
    acquisition, churn, accrual) gets a zero row for any month in which its
    frame has rows, as the single-pass aggregates of the report do."""
    spark = agg.sparkSession
    meta = component_table(spark, labels)
    present = agg.filter(F.col("family").isNotNull()).select("month_num", "family").distinct()
    grid = present.join(F.broadcast(meta.filter(F.col("family").isNotNull())), "family").select(
        "month_num", "component", "label", "sort_order"
    )
    filled = grid.join(agg.select("month_num", "component", "items_count", "cx_count", "taxable_revenue"),
                       ["month_num", "component"], "left").select(
        "month_num", "component", "label", "sort_order",
        F.coalesce("items_count", F.lit(0).cast("long")).alias("items_count"),
        F.coalesce("cx_count", F.lit(0).cast("long")).alias("cx_count"),
        F.coalesce("taxable_revenue", _zero()).cast("decimal(28,2)").alias("taxable_revenue"),
    )
    singles = agg.filter(F.col("family").isNull()).select(
        "month_num", "component", "label", "sort_order", "items_count", "cx_count", "taxable_revenue"
    )
    return filled.unionByName(singles)


def adjusted_opening(agg: DataFrame) -> DataFrame:
    """Opening plus MTP adjustment, per month."""
    return agg.filter(F.col("component").isin("R01", "R02")).groupBy("month_num").agg(
        F.sum("items_count").alias("items_count"),
        F.sum("cx_count").alias("cx_count"),
        F.sum("taxable_revenue").cast("decimal(28,2)").alias("taxable_revenue"),
    )


def closing(agg: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Adjusted opening plus the listed movements; items, customers and
    revenue use different member lists."""
    def part(members, col):
        return F.sum(F.when(F.col("component").isin(*members), F.col(col)).otherwise(F.lit(0)))

    moves = agg.groupBy("month_num").agg(
        part(CLOSING_ITEMS, "items_count").alias("d_items"),
        part(CLOSING_CUSTOMERS, "cx_count").alias("d_cx"),
        part(CLOSING_REVENUE, "taxable_revenue").alias("d_rev"),
    )
    return adjusted.join(moves, "month_num", "full").select(
        "month_num",
        (F.coalesce("items_count", F.lit(0)) + F.coalesce("d_items", F.lit(0))).cast("long").alias("items_count"),
        (F.coalesce("cx_count", F.lit(0)) + F.coalesce("d_cx", F.lit(0))).cast("long").alias("cx_count"),
        (F.coalesce("taxable_revenue", _zero()) + F.coalesce("d_rev", _zero())).cast("decimal(28,2)").alias("taxable_revenue"),
    )


def bridge_gap(agg: DataFrame, closing_rows: DataFrame) -> DataFrame:
    """Raw opening of month m+1 minus closing of month m."""
    opening = agg.filter(F.col("component") == "R01").select(
        (F.col("month_num") - 1).alias("month_num"),
        F.col("items_count").alias("o_items"), F.col("cx_count").alias("o_cx"), F.col("taxable_revenue").alias("o_rev"),
    )
    return closing_rows.join(opening, "month_num", "left").select(
        "month_num",
        (F.coalesce("o_items", F.lit(0)) - F.col("items_count")).cast("long").alias("items_count"),
        (F.coalesce("o_cx", F.lit(0)) - F.col("cx_count")).cast("long").alias("cx_count"),
        (F.coalesce("o_rev", _zero()) - F.col("taxable_revenue")).cast("decimal(28,2)").alias("taxable_revenue"),
    )


def bridge_wide(long_rows: DataFrame, n_months: int = 2) -> DataFrame:
    """One row per report line, month columns side by side."""
    aggs = []
    for m in range(1, n_months + 1):
        sel = F.col("month_num") == m
        aggs += [
            F.max(F.when(sel, F.col("items_count"))).alias(f"m{m}_items"),
            F.max(F.when(sel, F.col("cx_count"))).alias(f"m{m}_cx"),
            F.max(F.when(sel, F.col("taxable_revenue"))).alias(f"m{m}_rev"),
        ]
    return long_rows.groupBy("component", "sort_order").agg(*aggs)


def revenue_bridge(
    agg: DataFrame, n_months: int = 2, vas: DataFrame | None = None, labels: tuple[tuple[str, str], ...] = ()
) -> DataFrame:
    """The full report (components, adjusted opening, closing, gap),
    ordered by sort order with revenue rounded to 2 places.  With `vas`
    (the R29 frame) the VAS bridge is added into adjusted opening."""
    comps = all_components(agg, labels).select(
        "month_num", F.col("label").alias("component"), "sort_order", "items_count", "cx_count", "taxable_revenue"
    )
    adj = adjusted_opening(agg)
    if vas is not None:
        adj = vas_adjusted_opening(adj, vas)
    close = closing(agg, adj)
    gap = bridge_gap(agg, close).filter(F.col("month_num") < n_months)

    def labelled(df, label):
        return df.select("month_num", F.lit(label[0]).alias("component"), F.lit(label[1]).alias("sort_order"),
                         "items_count", "cx_count", "taxable_revenue")

    # the gap is reported in the month-1 columns only
    long_rows = comps.unionByName(labelled(adj, ADJUSTED_OPENING)).unionByName(labelled(close, TOTAL_CLOSING)).unionByName(
        labelled(gap, GAP)
    )
    wide = bridge_wide(long_rows, n_months)
    rounded = [F.round(F.col(f"m{m}_rev"), 2).cast("double").alias(f"m{m}_rev") for m in range(1, n_months + 1)]
    cols = []
    for m in range(1, n_months + 1):
        cols += [f"m{m}_items", f"m{m}_cx"]
    return wide.select("component", "sort_order", *cols, *rounded).orderBy("sort_order", "component")


def component_drilldown(rows: DataFrame, component: str | None = None) -> DataFrame:
    """Q01: the entity rows behind any component (before aggregation)."""
    return rows if component is None else rows.filter(F.col("component") == component)
