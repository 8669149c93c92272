"""Schedule-level transitions: renewal-overdue changes (R18, R19) and the
price-based plan transition (R16P / R17), all from the schedule grain (B09)
with one shared window per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revbridge.operators.base import ENTITY_KEYS
from revbridge.operators.movements import bucket


def tenure_windowed(grain: DataFrame) -> DataFrame:
    """LAG of tenure, dates, rate and recognition type over each entity's
    schedules (start, created, then schedule id to make ties deterministic)."""
    w = Window.partitionBy(*ENTITY_KEYS).orderBy("start_date", "created_at", "revenue_recognition_schedule_id")
    return grain.select(
        "*",
        F.lag("tenure").over(w).alias("previous_tenure"),
        F.lag("start_date").over(w).alias("previous_start_date"),
        F.lag("end_date").over(w).alias("previous_end_date"),
        F.lag("taxable_amount").over(w).alias("previous_taxable_amount"),
        F.lag("revenue_recognition_type").over(w).alias("previous_recognition_type"),
    )


def _users(directory: DataFrame) -> DataFrame:
    return directory.select(
        F.col("id").alias("accountable_entity_id"), F.col("entity_type").alias("accountable_entity_type"), "user_id"
    )


def _long(df: DataFrame, component) -> DataFrame:
    return df.select(
        "month_num",
        (F.lit(component) if isinstance(component, str) else component).alias("component"),
        F.col("accountable_entity_type").alias("entity_type"),
        F.col("accountable_entity_id").alias("entity_id"),
        F.col("user_id").cast("string").alias("customer"),
        (F.col("taxable_amount") - F.col("previous_taxable_amount")).cast("decimal(18,2)").alias("amount"),
    )


def renewal_overdue_rows(windowed: DataFrame, directory: DataFrame, months: DataFrame) -> DataFrame:
    """Schedules whose recognition type switched into ACCRUAL
    (positive) or from ACCRUAL to DEFERRAL (negative); delta of monthly rate."""
    prev, cur = F.col("previous_recognition_type"), F.col("revenue_recognition_type")
    df = windowed.filter(prev.isNotNull() & (prev != cur) & ((cur == "ACCRUAL") | (prev == "ACCRUAL")))
    j = bucket(df, "start_date", months).join(_users(directory), ENTITY_KEYS, "left")
    comp = F.when(cur == "ACCRUAL", "R18").when(cur == "DEFERRAL", "R19")
    return _long(j, comp).filter(F.col("component").isNotNull())


def plan_transition_price_rows(windowed: DataFrame, directory: DataFrame, months: DataFrame) -> DataFrame:
    """R16P / R17: monthly price delta of schedules whose tenure changed;
    positive = longer plan, negative = shorter, counted in the start month."""
    df = windowed.filter(
        F.col("previous_tenure").isNotNull()
        & (F.col("previous_tenure") != F.col("tenure"))
        & F.col("previous_end_date").isNotNull()
    )
    j = bucket(df, "start_date", months).join(_users(directory), ENTITY_KEYS, "left")
    comp = F.when(F.col("tenure") > F.col("previous_tenure"), "R16P").otherwise("R17")
    return _long(j, comp)
