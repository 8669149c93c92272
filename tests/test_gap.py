"""The gap drill-down adds up to A04, names causes, and takes one aggregate for any number of months."""
import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from revbridge.operators import assemble, reconcile
from revbridge.plans.bridge import BridgePlan
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

SF = "/root/testdata/sf0.001"
ROWS = "month_num int, component string, entity_type string, entity_id long, customer string, amount decimal(18,2)"


def totals(drill):
    out = drill.groupBy("month_num").agg(F.sum("items_count"), F.sum("cx_count"), F.sum("taxable_revenue")).collect()
    return {r[0]: (r[1], r[2], float(r[3])) for r in out}


def gap(agg):
    rows = assemble.bridge_gap(agg, assemble.closing(agg, assemble.adjusted_opening(agg))).collect()
    return {r.month_num: (r.items_count, r.cx_count, float(r.taxable_revenue)) for r in rows}


def causes(spark, *rows, months=2):
    from decimal import Decimal

    df = spark.createDataFrame([(m, c, "ITEM", e, x, Decimal(str(a))) for m, c, e, x, a in rows], ROWS)
    got = reconcile.gap_drilldown(df, months).filter("grain = 'ENTITY'").collect()
    return sorted((r.month_num, r.entity_id, r.cause, r.items_count, float(r.taxable_revenue)) for r in got)


def test_three_months_add_up(spark):
    policy = replace(fixture_policy(), months=(dt.date(1997, 1, 1), dt.date(1997, 2, 1), dt.date(1997, 3, 1)))
    with BridgePlan(spark, ledger_for(spark, SF), policy) as plan:
        drill = plan.stage(reconcile.gap_drilldown(plan.bridge_rows, 3))
        want = {m: v for m, v in gap(plan.aggregated).items() if m < 3}
        assert totals(drill) == want and set(want) == {1, 2}
        assert totals(reconcile.gap_causes(drill)) == want


@pytest.mark.parametrize("rows,want", [
    ([(1, "R01", 5, "u", 100), (2, "R01", 5, "u", 100)], []),
    ([(1, "R01", 5, "u", 100)], [(1, 5, "not opened without movement", -1, -100.0)]),
    ([(2, "R01", 5, "u", 100)], [(1, 5, "opened without movement", 1, 100.0)]),
    ([(1, "R01", 5, "u", 100), (1, "R08", 5, "u", 100)], []),
    ([(1, "R01", 5, "u", 100), (1, "R08", 5, "u", 90), (2, "R01", 5, "u", 100)], [(1, 5, "opened although moved out", 1, 90.0)]),
    ([(1, "R08", 5, "u", 40)], [(1, 5, "moved out without opening", 1, 40.0)]),
    ([(1, "R01", 5, "u", 100), (1, "R18", 5, "u", 30), (2, "R01", 5, "u", 150)], [(1, 5, "amount differs", 0, 20.0), (1, 5, "renewal overdue", 0, 30.0)]),
    ([(1, "R01", 5, "u", 100), (1, "R20", 5, "u", 30), (2, "R01", 5, "u", 90)], [(1, 5, "discount given", 0, -10.0)]),
    ([(2, "R01", 5, "u", 70), (2, "R02", 5, "u", 70)], [(1, 5, "early cycles of the next opening", 0, 70.0), (1, 5, "opened without movement", 1, 0.0)]),
    ([(1, "R15", 5, "u", 10)], [(1, 5, "amount without item", 0, -10.0)]),
    ([(1, "R01", 5, "u", 10), (1, "R04", 5, "u", 10), (2, "R01", 5, "u", 20)], [(1, 5, "counted in more than once", -1, 0.0)]),
])
def test_causes(spark, rows, want):
    assert causes(spark, *rows) == want


def test_sixty_months_take_no_join(spark):
    rows = spark.createDataFrame([(m, "R01", "ITEM", e, str(e % 3), None) for m in range(1, 61) for e in range(1 + m % 4)], ROWS)
    drill = reconcile.gap_drilldown(rows, 60)
    plan = drill._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Expand" not in plan
    agg = assemble.aggregate_components(rows)
    want = {m: v for m, v in gap(agg.fillna(0)).items() if m < 60 and any(v)}
    assert {m: v for m, v in totals(drill).items() if any(v)} == want
