"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them needs Python at run time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MONEY",
    "DISCOUNT_SCHEMA",
    "IST_OFFSET_MINUTES",
    "ist",
    "ist_date",
    "money",
    "tenure_months",
    "safe_div",
    "is_paid",
    "dec",
    "month_start",
    "next_month_start",
]

MONEY = "decimal(18,2)"
# Fixed value: JSON layout of the per-cycle discount list
DISCOUNT_SCHEMA = "array<struct<amount:double,catalogReferenceId:string,code:string>>"
# Fixed value: business dates are UTC + 330 minutes (IST)
IST_OFFSET_MINUTES = 330


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ist(ts) -> Column:
    """UTC wall-clock timestamp -> IST wall-clock timestamp."""
    return _c(ts) + F.make_dt_interval(mins=F.lit(IST_OFFSET_MINUTES))


def ist_date(ts) -> Column:
    """Business (IST) calendar date of a UTC timestamp."""
    return F.to_date(ist(ts))


def money(col) -> Column:
    return _c(col).cast(MONEY)


def dec(value: str | Decimal) -> Column:
    return F.lit(Decimal(str(value)))


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def tenure_months(start, end, days_per_month) -> Column:
    """round(days / days_per_month) on calendar dates (half-up, decimal)."""
    days = F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
    return F.round(days.cast("decimal(10,0)") / dec(days_per_month), 0).cast("int")


def is_paid(payment_json) -> Column:
    """Substring test kept as the ledger defines it (it also matches 'unpaid')."""
    return F.instr(F.lower(_c(payment_json).cast("string")), "paid") > 0


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def next_month_start(d) -> Column:
    return F.add_months(F.trunc(_c(d), "month"), 1)
