"""Movement components: acquisitions (R04, R05), churn events (R0C, R06-R11)
and penalty revenue (R15).

Each function returns *entity-level rows* in the shared long schema
(month_num, component, entity_type, entity_id, customer, amount); the
aggregation into items / customers / revenue happens once, in
`assemble.aggregate_components`.  Month bucketing joins the tiny month driver
on a derived month key (an equality), broadcast by construction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.functions import money
from revbridge.operators.churn import latest_cycles
from revbridge.operators.exclusion import not_in
from revbridge.policy import TXN_BUYOUT, TXN_RETURN, Policy
from revbridge.sources.ledger import Ledger

LONG = ["month_num", "component", "entity_type", "entity_id", "customer", "amount"]


def bucket(df: DataFrame, date_col, months: DataFrame) -> DataFrame:
    """Attach month_num for rows whose `date_col` falls in an analysis month."""
    m = F.broadcast(months.select("month_num", F.col("m_start").alias("_m")))
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return df.withColumn("_m", F.trunc(F.to_date(d), "month")).join(m, "_m").drop("_m")


def within(col: str, start: dt.date, stop: dt.date) -> F.Column:
    """start <= col < stop on a raw column, so that it reaches the scan."""
    return (F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(stop))


def acquisition_rows(L: Ledger, months: DataFrame, policy: Policy) -> DataFrame:
    """New customers and upsells by activation month."""
    flag = F.lower(F.col("flag"))
    acq = L.acquisitions.filter(within("activation_date", policy.first_start, policy.last_next) & flag.isin("new", "upsell"))
    return bucket(acq, "activation_date", months).select(
        "month_num",
        F.when(flag == "new", "R04").otherwise("R05").alias("component"),
        F.col("accountable_entity_type").alias("entity_type"),
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("fur_id").alias("customer"),
        money("taxable_amount").alias("amount"),
    )


def churn_date(policy: Policy) -> F.Column:
    return F.to_date("payment_date" if policy.churn_bucket == "payment" else "pickup_date")


def _event_rows(bucketed: DataFrame, mtp: DataFrame, policy: Policy) -> DataFrame:
    """Events without those of entities that have a current-month MTP (an entity is
    excluded as the policy says: NOT EXISTS, or NOT IN with its rules for NULLs)."""
    keys = mtp.select(F.col("accountable_entity_id").alias("entity_id"), F.col("accountable_entity_type").alias("entity_type"))
    names = ["entity_id", "entity_type"]
    kept = not_in(bucketed, keys, names) if policy.mtp_exclusion == "not_in" else bucketed.join(keys, names, "left_anti")
    return kept.select(
        "month_num", "entity_type", "entity_id",
        F.col("user_ids").cast("string").alias("customer"),
        money("taxable_amount").alias("amount"),
        "churn_flag", "transaction_type",
    )


def churn_events(churn: DataFrame, mtp: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """R0C from a churn table (a published one): latest-cycle rows of entities
    without a current-month MTP, bucketed by transaction (payment) date."""
    return _event_rows(bucket(churn.filter(F.col("rnk") == 1), churn_date(policy), months), mtp, policy)


def churned_in(tagged: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """The churned rows of C06 whose transaction falls in an analysis month."""
    day, flag = churn_date(policy), F.col("churn_flag") != "ACTIVE"
    inside = (day >= F.lit(policy.first_start)) & (day < F.lit(policy.last_next))
    return bucket(tagged.filter(flag & inside), day, months)


def month_churn_events(L: Ledger, tagged: DataFrame, mtp: DataFrame, months: DataFrame, policy: Policy, stage=lambda df: df) -> DataFrame:
    """R0C without a churn table: rows are cut to the months first, and only their
    entities' cycles are ranked."""
    rows = churned_in(tagged, months, policy)
    month = bucket(latest_cycles(L, policy, rows.drop("month_num"), stage), churn_date(policy), months)
    return _event_rows(month, mtp, policy)


CHURN_RULES = {
    "R06": (TXN_RETURN, None),
    "R07": (TXN_RETURN, "PARTIAL"),
    "R08": (TXN_RETURN, "FULL"),
    "R09": (TXN_BUYOUT, None),
    "R10": (TXN_BUYOUT, "PARTIAL"),
    "R11": (TXN_BUYOUT, "FULL"),
}


def churn_component_rows(events: DataFrame, components=tuple(CHURN_RULES)) -> DataFrame:
    """Total / partial / full pickups and buy-outs."""
    tags = []
    for comp in components:
        txn, flag = CHURN_RULES[comp]
        cond = F.col("transaction_type") == txn
        if flag is not None:
            cond = cond & (F.col("churn_flag") == flag)
        tags.append(F.when(cond, F.lit(comp)))
    return events.select("*", F.explode(F.filter(F.array(*tags), lambda c: c.isNotNull())).alias("component")).select(
        *LONG
    )


def penalty_rows(penalty_cycles: DataFrame, L: Ledger, months: DataFrame) -> DataFrame:
    """Penalty cycles recognised (IST) in the month."""
    pl = L.penalty.select(
        F.col("id").alias("accountable_entity_id"), "product_entity_id", F.col("user_id").alias("pl_user_id")
    )
    j = penalty_cycles.join(pl, "accountable_entity_id")
    return bucket(j, "recognised_at_ist", months).select(
        "month_num",
        F.lit("R15").alias("component"),
        F.lit("PENALTY").alias("entity_type"),
        F.col("product_entity_id").alias("entity_id"),
        F.col("pl_user_id").cast("string").alias("customer"),
        money("taxable_amount").alias("amount"),
    )
