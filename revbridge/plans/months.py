"""Month drivers.

A driver row is (month_num, m_start, m_next, m_end, prev_start, m_label):
`m_next` is the exclusive next-month start, `m_end` the inclusive last day.
Drivers are tiny (one row per analysis month), so joining them by
`broadcast` is bounded by the number of requested months, not by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _shape(df: DataFrame) -> DataFrame:
    m = F.trunc(F.col("anchor"), "month")
    return df.select(
        F.col("month_num").cast("int").alias("month_num"),
        m.alias("m_start"),
        F.add_months(m, 1).alias("m_next"),
        F.date_add(F.add_months(m, 1), -1).alias("m_end"),
        F.add_months(m, -1).alias("prev_start"),
        F.date_format(m, "MMM yyyy").alias("m_label"),
    )


def month_driver(spark: SparkSession, starts) -> DataFrame:
    """One row per analysis month, numbered in the order given."""
    rows = [(i + 1, d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))) for i, d in enumerate(starts)]
    return _shape(spark.createDataFrame(rows, "month_num int, anchor date"))


def trailing_months(as_of: dt.date, n: int = 12) -> tuple[dt.date, ...]:
    """Starts of the `n` months ending with the month of `as_of` (the months of B08, for a Policy)."""
    last = as_of.year * 12 + as_of.month - 1
    return tuple(dt.date(m // 12, m % 12 + 1, 1) for m in range(last - n + 1, last + 1))


def rolling_month_driver(spark: SparkSession, as_of: dt.date, n: int = 12) -> DataFrame:
    """The `n` months ending with the month of `as_of`, oldest first.

    `as_of` is a parameter (never the wall clock), so reruns are reproducible.
    """
    base = spark.range(1).select(F.lit(as_of).cast("date").alias("as_of"))
    offsets = base.select(
        "as_of", F.explode(F.sequence(F.lit(n - 1), F.lit(0), F.lit(-1))).alias("month_offset")
    )
    return _shape(
        offsets.select(
            (F.lit(n) - F.col("month_offset")).alias("month_num"),
            F.add_months(F.trunc("as_of", "month"), -F.col("month_offset")).alias("anchor"),
        )
    )
