"""Reporting periods of any kind (P01): fiscal calendars, uneven or overlapping ranges.

The month rules derive a cycle's month from its own dates, which only a calendar allows.
Here a rule asks which of a list of half-open ranges hold a date.  The sorted boundaries of
the list are literals of the plan; a date finds its place among them by bisection inside an
expression, and the place knows the ranges that cover it.  So the ledger meets no period
table, whatever the periods: no join, no nested loop.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.operators.classify import CMTP, S11, S12
from revbridge.policy import Policy


@dataclass(frozen=True)
class Period:
    """A reporting period [start, stop) and the one it is compared with, [previous, start)."""

    number: int
    previous: dt.date
    start: dt.date
    stop: dt.date


def calendar_months(months) -> list[Period]:
    out = []
    for n, m in enumerate(sorted(months), 1):
        m = m.replace(day=1)
        out.append(Period(n, (m - dt.timedelta(days=1)).replace(day=1), m, (m + dt.timedelta(days=32)).replace(day=1)))
    return out


def week_pattern(first: dt.date, years: int = 1, weeks: tuple[int, ...] = (4, 4, 5)) -> list[Period]:
    """Periods of so many weeks, repeating (4-4-5: thirteen weeks a quarter)."""
    out, start, before = [], first, first - dt.timedelta(weeks=weeks[-1])
    for n in range(12 * years):
        stop = start + dt.timedelta(weeks=weeks[n % len(weeks)])
        out.append(Period(n + 1, before, start, stop))
        before, start = start, stop
    return out


def holding(date: F.Column, ranges: list[tuple[int, dt.date, dt.date]]) -> F.Column:
    """Numbers of the ranges [low, high) that hold `date`, ascending (none for NULL)."""
    bounds = sorted({d for _, low, high in ranges for d in (low, high)})
    covered = [sorted({n for n, low, high in ranges if low <= b < high}) for b in bounds]
    marks = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    # the number of bounds on or before the date, bit by bit
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds)) & (F.try_element_at(marks, at + s) <= date), at + s).otherwise(at),
    )
    none = F.array().cast("array<int>")
    lists = F.array(none, *[F.array(*[F.lit(n) for n in c]).cast("array<int>") if c else none for c in covered])
    return F.when(date.isNull(), none).otherwise(F.element_at(lists, place + 1))


def classify_periods(cycles: DataFrame, periods: list[Period], policy: Policy) -> DataFrame:
    """One row per (cycle, period, tag), as R00 has it per month; periods may overlap."""
    start, rec = F.col("start_date"), F.col("recognised_at")
    day = F.col("synthetic_recognised_at") if policy.current_mtp_date == "adjusted" else rec
    known = {p.number: p for p in periods}
    if len(known) < len(periods):
        raise ValueError("period numbers repeat")
    before = [(p.number, p.previous, p.start) for p in periods]
    inside = [(p.number, p.start, p.stop) for p in periods]

    def edge(what: str):
        table = F.create_map(*[x for n, p in known.items() for x in (F.lit(n), F.lit(getattr(p, what)))])
        return lambda n: table[n]

    starts, stops, previous = edge("start"), edge("stop"), edge("previous")
    recognised = {
        "cycle_start": lambda n: rec.isNull() | (rec >= start), "prev_start": lambda n: rec.isNull() | (rec >= previous(n)),
        "month_start": lambda n: rec.isNull() | (rec >= starts(n)),
    }[policy.s11_recognised_rule]
    tagged = lambda tag, numbers: F.transform(numbers, lambda n: F.struct(F.lit(tag).alias("tag"), n.alias("period")))
    every = F.concat(
        tagged(S11, F.filter(holding(start, before), recognised)),
        tagged(S12, F.filter(holding(rec, before), lambda n: start >= starts(n))),
        tagged(CMTP, F.filter(holding(day, inside), lambda n: start >= stops(n))),
    )
    return cycles.select("*", F.explode(every).alias("t")).select("*", "t.tag", "t.period").drop("t")


def period_revenue(classified: DataFrame) -> DataFrame:
    """Items, customers and revenue per period and tag."""
    return classified.groupBy("period", "tag").agg(
        F.count_distinct("accountable_entity_type", "accountable_entity_id").alias("items_count"),
        F.count_distinct("user_id").alias("cx_count"), F.sum("taxable_amount").cast("decimal(28,2)").alias("taxable_revenue"),
    )
