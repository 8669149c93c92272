"""Gap drill-down (Q02, Q03): the entities and customers behind A04.

The gap of month m is the raw opening of m + 1 less the closing of m.  Both are sums over
component rows, so one grouped aggregate over the rows gives every entity's share of it: a
row stands on the closing side of its own month, and an opening row also on the opening
side of the month before.  Nothing is joined, whatever the number of months.

Items and revenue add up over entities, customers over customers, exactly to A04 (which
has a row for every month with any component row).  An entity's revenue residual is
assigned, in this order and each time no further than the residual reaches:

1. early cycles of the next opening (its MTP rows, R02): raw opening holds them
2. renewal-overdue changes of the month (R18, R19), which closing does not count
3. discounts given in the month (R20, lowering what is opened)
4. what is left goes to the entity's state, as do its items
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.policy import CLOSING_CUSTOMERS, CLOSING_ITEMS, CLOSING_REVENUE, COMPONENTS

OPENING, EARLY, RENEWAL, DISCOUNT = "R01", "R02", ("R18", "R19"), "R20"
SIGN = {cid: sign for cid, _, _, sign, _ in COMPONENTS}
ITEMS = [OPENING, EARLY, *CLOSING_ITEMS]
CUSTOMERS = [OPENING, EARLY, *CLOSING_CUSTOMERS]
REVENUE = [OPENING, EARLY, *CLOSING_REVENUE]
COLUMNS = ["month_num", "grain", "entity_type", "entity_id", "customer", "cause", "component", "items_count", "cx_count", "taxable_revenue"]


def sides(rows: DataFrame, n_months: int) -> DataFrame:
    """Component rows with the month of the gap they belong to and their side of it:
    closing, opening, early (cycles of the next month's MTP) or other."""
    comp, own = F.col("component"), F.col("month_num")
    side = lambda name, month, *of: F.when(comp.isin(*of), F.struct(month.alias("gap_month"), F.lit(name).alias("side")))
    stands = F.array(
        side("closing", own, *REVENUE), side("opening", own - 1, OPENING), side("early", own - 1, EARLY), side("other", own, *RENEWAL, DISCOUNT)
    )
    out = rows.select("component", "entity_type", "entity_id", "customer", "amount", F.explode(F.filter(stands, lambda s: s.isNotNull())).alias("s"))
    return out.select("*", "s.gap_month", "s.side").drop("s").filter(F.col("gap_month").between(1, n_months - 1))


def _counted(members: list[str], there: F.Column) -> F.Column:
    """Signed number of member components that have a row for the group."""
    return reduce(lambda a, b: a + b, [F.max(F.when((F.col("side") == "closing") & (F.col("component") == c) & there, 1).otherwise(0)) * SIGN[c] for c in members])


def _money(cond: F.Column, value: F.Column | None = None) -> F.Column:
    amount = F.col("amount") if value is None else value
    return F.coalesce(F.sum(F.when(cond, amount)), F.lit(0)).cast("decimal(28,2)")


def _toward(residual: F.Column, amount: F.Column) -> F.Column:
    """The part of `residual` that `amount` explains: same sign, no further than it reaches."""
    zero = F.lit(0).cast("decimal(28,2)")
    return F.when((residual > 0) & (amount > 0), F.least(residual, amount)).when((residual < 0) & (amount < 0), F.greatest(residual, amount)).otherwise(zero)


def entity_residuals(stands: DataFrame) -> DataFrame:
    """One row per gap month and entity: items and revenue of both sides, and what may explain them."""
    there = F.col("entity_type").isNotNull() & F.col("entity_id").isNotNull()
    side, comp = F.col("side"), F.col("component")
    sign = reduce(lambda w, c: w.when(comp == c, SIGN[c]), REVENUE[1:], F.when(comp == REVENUE[0], SIGN[REVENUE[0]]))
    return stands.groupBy("gap_month", "entity_type", "entity_id").agg(
        F.max(F.when((side == "opening") & there, 1).otherwise(0)).alias("opened"),
        _counted(ITEMS, there).alias("closed"),
        F.max(F.when((side == "closing") & comp.isin(*ITEMS), 1).otherwise(0)).alias("moved"),
        _money(side == "opening").alias("opening"),
        _money(side == "closing", F.col("amount") * sign).alias("closing"),
        _money(side == "early").alias("early"),
        _money((side == "other") & comp.isin(*RENEWAL)).alias("renewal"),
        _money((side == "other") & (comp == DISCOUNT)).alias("discount"),
    )


def _state() -> F.Column:
    opened, closed, moved = F.col("opened") == 1, F.col("closed"), F.col("moved") == 1
    return (
        F.when(opened & (closed > 0), F.when(closed == 1, "amount differs").otherwise("counted in more than once"))
        .when(opened & moved, "opened although moved out")
        .when(opened, "opened without movement")
        .when(closed > 0, "not opened without movement")
        .when(closed < 0, "moved out without opening")
        .otherwise("amount without item")
    )


def gap_drilldown(rows: DataFrame, n_months: int) -> DataFrame:
    """Q02: the gap of every month but the last, per entity and cause (grain ENTITY: items
    and revenue) and per customer (grain CUSTOMER: customers); only what is not zero."""
    stands = sides(rows, n_months)
    e = entity_residuals(stands).withColumn("residual", F.col("opening") - F.col("closing"))
    for name, amount in (("by_early", F.col("early")), ("by_renewal", F.col("renewal")), ("by_discount", -F.col("discount"))):
        part = _toward(F.col("residual"), amount)
        e = e.withColumn(name, part).withColumn("residual", (F.col("residual") - F.col(name)).cast("decimal(28,2)"))
    zero = F.lit(0)
    cause = lambda text, component, amount, items=zero: F.struct(
        (F.lit(text) if isinstance(text, str) else text).alias("cause"), F.lit(component).cast("string").alias("component"),
        items.cast("long").alias("items_count"), amount.cast("decimal(28,2)").alias("taxable_revenue"),
    )
    causes = F.array(
        cause("early cycles of the next opening", EARLY, F.col("by_early")),
        cause("renewal overdue", "/".join(RENEWAL), F.col("by_renewal")),
        cause("discount given", DISCOUNT, F.col("by_discount")),
        cause(_state(), None, F.col("residual"), F.col("opened") - F.col("closed")),
    )
    entities = e.select(
        F.col("gap_month").alias("month_num"), F.lit("ENTITY").alias("grain"), "entity_type", "entity_id", F.lit(None).cast("string").alias("customer"),
        F.explode(F.filter(causes, lambda c: (c["items_count"] != 0) | (c["taxable_revenue"] != 0))).alias("c"),
    ).select("*", "c.*", zero.cast("long").alias("cx_count"))

    known = F.col("customer").isNotNull()
    c = stands.filter(known & F.col("side").isin("closing", "opening")).groupBy("gap_month", "customer").agg(
        F.max((F.col("side") == "opening").cast("int")).alias("opened"), _counted(CUSTOMERS, known).alias("closed")
    )
    customers = c.filter("opened <> closed").select(
        F.col("gap_month").alias("month_num"), F.lit("CUSTOMER").alias("grain"), F.lit(None).cast("string").alias("entity_type"),
        F.lit(None).cast("long").alias("entity_id"), "customer",
        F.when(F.col("opened") > F.col("closed"), "customer opened, not in closing").otherwise("customer in closing, not opened").alias("cause"),
        F.lit(None).cast("string").alias("component"), zero.cast("long").alias("items_count"),
        (F.col("opened") - F.col("closed")).cast("long").alias("cx_count"), zero.cast("decimal(28,2)").alias("taxable_revenue"),
    )
    return entities.select(COLUMNS).unionByName(customers.select(COLUMNS))


def gap_causes(drilldown: DataFrame) -> DataFrame:
    """Q03: the gap of every month by cause; the rows of a month add up to A04."""
    return drilldown.groupBy("month_num", "grain", "cause", "component").agg(
        F.count("*").alias("n_rows"), F.sum("items_count").alias("items_count"), F.sum("cx_count").alias("cx_count"),
        F.sum("taxable_revenue").cast("decimal(28,2)").alias("taxable_revenue"),
    )
