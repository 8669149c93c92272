"""Fiscal and overlapping periods; calendar months give the month rules' result."""
import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from revbridge.operators import periods
from revbridge.plans.bridge import BridgePlan
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

SF = "/root/testdata/sf0.001"


def test_places_of_dates(spark):
    d = dt.date(2026, 1, 1)
    ranges = [(1, d, d + dt.timedelta(7)), (2, d + dt.timedelta(3), d + dt.timedelta(10)), (3, d + dt.timedelta(20), d + dt.timedelta(21)), (4, d, d)]
    days = [d + dt.timedelta(n) for n in range(-2, 25)] + [None]
    got = [tuple(r[0]) for r in spark.createDataFrame([(x,) for x in days], "d date").select(periods.holding(F.col("d"), ranges)).collect()]
    assert got == [tuple(n for n, low, high in ranges if x is not None and low <= x < high) for x in days]


def test_four_four_five():
    year = periods.week_pattern(dt.date(2025, 12, 29), years=2)
    assert len(year) == 24 and [(p.stop - p.start).days // 7 for p in year[:6]] == [4, 4, 5, 4, 4, 5]
    assert year[11].stop - year[0].start == dt.timedelta(weeks=52) and all(a.start == b.previous and a.stop == b.start for a, b in zip(year, year[1:]))


@pytest.mark.parametrize("rule", ["cycle_start", "prev_start", "month_start"])
def test_calendar_months_equal_the_month_rules(spark, rule):
    policy = replace(fixture_policy(), s11_recognised_rule=rule)
    with BridgePlan(spark, ledger_for(spark, SF), policy) as plan:
        keys = ["tag", "accountable_entity_id", "start_date", "taxable_amount"]
        own = periods.classify_periods(plan.opening_cycles, periods.calendar_months(policy.months), policy)
        assert sorted(map(str, own.select("period", *keys).collect())) == sorted(
            map(str, plan.classified.select(F.col("month_num").alias("period"), *keys).collect())
        )
        text = own._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
