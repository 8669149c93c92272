"""Opening and minimum-tenure components (R00-R03, R14, R0X).

R00 tags each cycle with the analysis months it belongs to.  Instead of the
OR-of-ranges join (a nested-loop join that grows with months x cycles), each
rule derives the one month it can belong to from the cycle's own dates:

* S1.1 (normal opening): start in the previous month      -> m = start month + 1
* S1.2 (MTP opening):    recognised in the previous month  -> m = recognised month + 1,
                         and the cycle starts on/after m
* current-month MTP:     recognised in the month           -> m = recognised month,
                         and the cycle starts after the month

so the month driver joins on an equality and is broadcast (it is tiny).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.operators.base import ENTITY_KEYS
from revbridge.policy import Policy

S11, S12, CMTP = "S1.1", "S1.2", "CMTP"


def classify_cycles(cycles: DataFrame, months: DataFrame, policy: Policy) -> DataFrame:
    """One row per (cycle, month, tag) with tag in {S1.1, S1.2, CMTP}.

    `cycles` is the B06 frame (start_date, recognised_at, synthetic_recognised_at).
    """
    start, rec = F.col("start_date"), F.col("recognised_at")
    s11_month = F.add_months(F.trunc(start, "month"), 1)
    if policy.s11_recognised_rule == "cycle_start":
        s11_ok = rec.isNull() | (rec >= start)
    elif policy.s11_recognised_rule == "prev_start":
        s11_ok = rec.isNull() | (rec >= F.trunc(start, "month"))
    elif policy.s11_recognised_rule == "month_start":
        s11_ok = rec.isNull() | (rec >= s11_month)
    elif policy.s11_recognised_rule == "other_month":
        s11_ok = rec.isNull() | (F.trunc(rec, "month") != F.trunc(start, "month"))
    else:
        raise ValueError(policy.s11_recognised_rule)
    s12_month = F.add_months(F.trunc(rec, "month"), 1)
    cm_date = F.col("synthetic_recognised_at") if policy.current_mtp_date == "adjusted" else rec
    cm_month = F.trunc(cm_date, "month")
    tags = F.array(
        F.when(s11_ok, F.struct(F.lit(S11).alias("tag"), s11_month.alias("m_start"))),
        F.when(start >= s12_month, F.struct(F.lit(S12).alias("tag"), s12_month.alias("m_start"))),
        F.when(start >= F.add_months(cm_month, 1), F.struct(F.lit(CMTP).alias("tag"), cm_month.alias("m_start"))),
    )
    tagged = cycles.select("*", F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("t")).select(
        "*", F.col("t.tag").alias("tag"), F.col("t.m_start").alias("m_start")
    ).drop("t")
    m = F.broadcast(months.select("month_num", "m_start"))
    return tagged.join(m, "m_start").drop("m_start")


def _rows(classified: DataFrame, component: str, tags: list[str]) -> DataFrame:
    return classified.filter(F.col("tag").isin(*tags)).select(
        "month_num",
        F.lit(component).alias("component"),
        F.col("accountable_entity_type").alias("entity_type"),
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"),
        F.col("taxable_amount").alias("amount"),
    )


def opening_rows(classified: DataFrame) -> DataFrame:
    """S1.1 and S1.2 cycles of each month."""
    return _rows(classified, "R01", [S11, S12])


def mtp_adjustment_rows(classified: DataFrame) -> DataFrame:
    """S1.2 cycles (negated by the component table)."""
    return _rows(classified, "R02", [S12])


def current_mtp_rows(classified: DataFrame) -> DataFrame:
    """Cycles recognised in the month that start after it (negated)."""
    return _rows(classified, "R14", [CMTP])


def mtp_entities(classified: DataFrame) -> DataFrame:
    """R0X: entities with a current-month MTP cycle in any analysis month."""
    return classified.filter(F.col("tag") == CMTP).select(*ENTITY_KEYS).distinct()
