"""Worked examples of the component definitions, as tiny hand-made ledgers.

Months: January / February 2026.  Each test builds only the rows it needs.
"""
import datetime as dt
from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revbridge.operators import assemble, cycles
from revbridge.plans.bridge import BridgePlan
from revbridge.plans.months import rolling_month_driver, trailing_months
from revbridge.policy import FAMILIES, Policy
from revbridge.sources.ledger import Ledger

POLICY = Policy(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1)), as_of=dt.date(2026, 6, 1))


def ts(s):
    return dt.datetime.fromisoformat(s)


def item(i, user, act="2025-06-01 10:00:00", pickup=None, composite=None, state="ACTIVE"):
    return (i, user, 100 + i, state, "RENTAL", ts(act), ts(pickup) if pickup else None, composite or i, f"item-{i}", '{"basePrice":100}')


def cycle(eid, start, amount, rec=None, etype="ITEM", sched=None, rtype="ACCRUAL", disc=None, ext="ORDER"):
    s = ts(start + " 00:00:00")
    r = ts(rec) if rec else s + dt.timedelta(days=2)
    return (eid * 10, eid, etype, rtype, "RECOGNISED", "RENTAL", s, s + dt.timedelta(days=29), r,
            s - dt.timedelta(days=1), None, ext, 1, sched, Decimal(str(amount)), disc)


def component(plan, comp):
    members = next((m for m in FAMILIES.values() if comp in m), [comp])
    rows = plan.families(members)
    agg = assemble.all_components(assemble.aggregate_components(rows, plan.policy.labels), plan.policy.labels)
    rows = agg.filter(F.col("component") == comp).select("month_num", "items_count", "cx_count", "taxable_revenue").collect()
    return {r.month_num: (r.items_count, r.cx_count, float(r.taxable_revenue)) for r in rows}


def swap(i, action, day):
    return (i, i, None, "FULFILLED", action, *[None] * 8, ts(day))


def returned(i, user, day, kind="COMPLETED"):
    return (i, i, user, kind, ts(day + " 06:00:00"), ts(day + " 08:00:00"))


def plan_of(spark, policy=POLICY, **rows):
    return BridgePlan(spark, Ledger.from_rows(spark, **rows), policy, materialize="table")


def test_opening_normal_and_early_cycle(spark):
    # normal cycle started in December, recognised after its start -> January opening
    # early cycle starts in February but was recognised in December -> opening, reversed by MTP
    p = plan_of(
        spark,
        items=[item(1, 7), item(2, 8)],
        recognitions=[cycle(1, "2025-12-15", 1000, rec="2025-12-20 08:00:00"),
                      cycle(2, "2026-02-01", 500, rec="2025-12-28 08:00:00")],
    )
    assert component(p, "R01")[1] == (2, 2, 1500.0)
    assert component(p, "R02")[1] == (-1, -1, -500.0)


def test_early_recognition_is_current_month_mtp(spark):
    # a March cycle recognised on 2026-01-05 is current-month MTP in January
    p = plan_of(spark, items=[item(1, 7)], recognitions=[cycle(1, "2026-03-01", 800, rec="2026-01-05 09:00:00")])
    assert component(p, "R14")[1] == (-1, -1, -800.0)


def test_full_pickup_single_item(spark):
    # the user's only item is returned on 10 January: total and full pickup -1, -1, -1200
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00")],
        recognitions=[cycle(1, "2025-12-15", 1200)],
        return_items=[(1, 1, 7, "COMPLETED", ts("2026-01-10 06:00:00"), ts("2026-01-11 06:00:00"))],
    )
    assert component(p, "R06")[1] == (-1, -1, -1200.0)
    assert component(p, "R08")[1] == (-1, -1, -1200.0)
    assert component(p, "R07")[1] == (0, 0, 0.0)


def test_cancelled_return_is_no_churn(spark):
    p = plan_of(
        spark,
        items=[item(1, 7)],
        recognitions=[cycle(1, "2025-12-15", 1200)],
        return_items=[(1, 1, 7, "CANCELLED", ts("2026-01-10 06:00:00"), ts("2026-01-11 06:00:00"))],
    )
    assert component(p, "R06") == {}


def test_partial_pickup_one_of_two(spark):
    # one of two items returned: items -1, customers 0, revenue -1200
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00"), item(2, 7)],
        recognitions=[cycle(1, "2025-12-15", 1200), cycle(2, "2025-12-15", 800)],
        return_items=[(1, 1, 7, "COMPLETED", ts("2026-01-10 06:00:00"), ts("2026-01-11 06:00:00"))],
    )
    assert component(p, "R07")[1] == (-1, 0, -1200.0)
    assert component(p, "R08")[1] == (0, 0, 0.0)


def test_buyout_item_and_attachment_full(spark):
    # paid buy-out of the only item; its attachment follows through the composite id
    p = plan_of(
        spark,
        items=[item(1, 7, composite=50)],
        attachments=[item(2, 7, composite=50)],
        recognitions=[cycle(1, "2025-12-15", 900), cycle(2, "2025-12-15", 800, etype="ATTACHMENT")],
        rtp_items=[(1, 1, 91, '{"status":"PAID"}', '{"byCashPreTax":"5000"}')],
        rtp_orders=[(91, "CONFIRMED", ts("2026-01-05 04:00:00"))],
    )
    assert component(p, "R09")[1] == (-2, -1, -1700.0)
    assert component(p, "R11")[1] == (-2, -1, -1700.0)


def test_swaps_out_and_in(spark):
    p = plan_of(
        spark,
        items=[item(1, 7), item(2, 7)],
        recognitions=[cycle(1, "2026-01-01", 1200), cycle(2, "2026-01-20", 1500)],
        swap_items=[swap(1, "SWAP_OUT", "2026-01-12 05:00:00"), swap(2, "SWAP_IN", "2026-01-12 05:00:00")],
    )
    assert component(p, "R12")[1] == (-1, 0, -1200.0)
    assert component(p, "R13")[1] == (1, 0, 1500.0)


def test_penalty_in_ist_month(spark):
    # recognised 2026-01-13 20:00 UTC = 2026-01-14 IST -> January
    pen = (77, 77, "PENALTY", "ACCRUAL", "RECOGNISED", "RENTAL", ts("2026-01-01 00:00:00"), ts("2026-01-30 00:00:00"),
           ts("2026-01-13 20:00:00"), ts("2025-12-31 00:00:00"), None, "ORDER", 1, None, Decimal("250"), None)
    p = plan_of(spark, items=[item(1, 7)], recognitions=[pen], penalty=[(77, 1, 7)])
    assert component(p, "R15")[1] == (1, 1, 250.0)


def test_plan_transition_longer_tenure(spark):
    # schedule of 6 months with upfront 500, then 12 months with upfront 800: -300,
    # counted in the month after the new cycle starts (February for a January start)
    d6 = '[{"amount":500.0,"catalogReferenceId":"1"}]'
    d12 = '[{"amount":800.0,"catalogReferenceId":"1"}]'
    p = plan_of(
        spark,
        items=[item(1, 7)],
        schedules=[(11, ts("2025-07-01 00:00:00"), ts("2025-12-31 00:00:00"), Decimal("6000"), Decimal("7080")),
                   (12, ts("2026-01-01 00:00:00"), ts("2026-12-31 00:00:00"), Decimal("12000"), Decimal("14160"))],
        recognitions=[cycle(1, "2025-12-01", 1000, sched=11, disc=d6), cycle(1, "2026-01-01", 1000, sched=12, disc=d12)],
        discounts=[(1, "UPFRONT")],
    )
    assert component(p, "R16")[2] == (1, 1, -300.0)


def test_discount_change(spark):
    # non-upfront discount 200 -> 350 between consecutive cycles: -150 in the next month
    p = plan_of(
        spark,
        items=[item(1, 7)],
        recognitions=[cycle(1, "2025-12-01", 1000, disc='[{"amount":200.0,"catalogReferenceId":"2"}]'),
                      cycle(1, "2026-01-01", 1000, disc='[{"amount":350.0,"catalogReferenceId":"2"}]')],
        discounts=[(2, "LOYALTY")],
    )
    assert component(p, "R21")[2] == (1, 1, -150.0)
    assert component(p, "R20")[1] == (1, 1, 350.0)


def test_report_has_all_rows(spark):
    p = plan_of(spark, items=[item(1, 7)], recognitions=[cycle(1, "2025-12-15", 1000)])
    names = {r.component for r in p.report().collect()}
    assert {"Opening_revenue", "Adjusted opening", "Total closing Revenue", "Gap (Month1 Closing vs Month2 Opening)"} <= names


def test_churn_table_sink_roundtrip(spark, tmp_path):
    from revbridge.operators.churn import write_churn_table

    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00")],
        recognitions=[cycle(1, "2025-12-15", 1200)],
        return_items=[(1, 1, 7, "COMPLETED", ts("2026-01-10 06:00:00"), ts("2026-01-11 06:00:00"))],
    )
    out = str(tmp_path / "churn")
    write_churn_table(p.churn_table, path=out)
    back = spark.read.parquet(out).collect()
    assert [(r.entity_id, r.churn_flag, r.rnk) for r in back] == [(1, "FULL", 1)]


# ---- churn: attachments, several entities, months -------------------------------


def test_item_and_attachment_returned(spark):
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00", composite=50)], attachments=[item(2, 7, composite=50)],
        recognitions=[cycle(1, "2025-12-15", 1200), cycle(2, "2025-12-15", 200, etype="ATTACHMENT")],
        return_items=[returned(1, 7, "2026-01-10")],
    )
    assert component(p, "R06")[1] == (-2, -1, -1400.0)


def test_partial_pickup_with_attachment(spark):
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00", composite=50), item(3, 7)], attachments=[item(2, 7, composite=50)],
        recognitions=[cycle(1, "2025-12-15", 900), cycle(2, "2025-12-15", 150, etype="ATTACHMENT"), cycle(3, "2025-12-15", 700)],
        return_items=[returned(1, 7, "2026-01-10")],
    )
    assert component(p, "R07")[1] == (-2, 0, -1050.0)


def test_full_pickup_of_three_entities(spark):
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-13 10:00:00", composite=50), item(3, 7, pickup="2026-01-13 10:00:00")],
        attachments=[item(2, 7, composite=50)],
        recognitions=[cycle(1, "2025-12-15", 1200), cycle(2, "2025-12-15", 300, etype="ATTACHMENT"), cycle(3, "2025-12-15", 800)],
        return_items=[returned(1, 7, "2026-01-10"), returned(3, 7, "2026-01-10")],
    )
    assert component(p, "R08")[1] == (-3, -1, -2300.0)


def test_return_of_a_prior_month_counts_there(spark):
    # requested in December, picked up in January: bucketed by request, before the first month
    p = plan_of(
        spark,
        items=[item(1, 7, pickup="2026-01-03 10:00:00")],
        recognitions=[cycle(1, "2025-12-15", 1200)],
        return_items=[returned(1, 7, "2025-12-28")],
    )
    assert component(p, "R06") == {}


def test_buyout_partial(spark):
    p = plan_of(
        spark,
        items=[item(1, 7), item(2, 7)],
        recognitions=[cycle(1, "2025-12-15", 900), cycle(2, "2025-12-15", 500)],
        rtp_items=[(1, 1, 91, '{"status":"PAID"}', '{"byCashPreTax":"5000"}')],
        rtp_orders=[(91, "CONFIRMED", ts("2026-01-05 04:00:00"))],
    )
    assert component(p, "R10")[1] == (-1, 0, -900.0)


def test_two_paid_buyouts_of_one_item_count_once_each(spark):
    # the second line's order is cancelled: both transactions stay, the revenue is not multiplied
    rows = dict(
        items=[item(1, 7)],
        recognitions=[cycle(1, "2025-12-15", 900)],
        rtp_items=[(n, 1, 90 + n, '{"status":"PAID"}', '{"byCashPreTax":"5000"}') for n in (1, 2)],
        rtp_orders=[(91, "CONFIRMED", ts("2026-01-05 04:00:00")), (92, "CANCELLED", ts("2026-01-20 04:00:00"))],
    )
    assert component(plan_of(spark, **rows), "R09")[1] == (-1, -1, -1800.0)
    assert component(plan_of(spark, **rows), "R10")[1] == (0, 0, 0.0)
    assert component(plan_of(spark, **rows), "R11")[1] == (-1, -1, -1800.0)


# ---- plan transition and discounts ------------------------------------------------


def term(i, start, months, amount=6000):
    s = ts(start + " 00:00:00")
    return (i, s, s + dt.timedelta(days=round(30.45 * months)), Decimal(amount), Decimal(amount))


def upfront(amount):
    return f'[{{"amount":{amount},"catalogReferenceId":"1"}}]'


@pytest.mark.parametrize("first,second,delta", [((12, 800.0), (6, 500.0), 300.0), ((6, 180.50), (12, 169.67), 10.83)])
def test_plan_transition(spark, first, second, delta):
    p = plan_of(
        spark,
        items=[item(1, 7)], schedules=[term(11, "2025-07-01", first[0]), term(12, "2026-01-01", second[0])],
        recognitions=[cycle(1, "2025-12-01", 1000, sched=11, disc=upfront(first[1])), cycle(1, "2026-01-01", 1000, sched=12, disc=upfront(second[1]))],
        discounts=[(1, "UPFRONT")],
    )
    assert component(p, "R16")[2] == (1, 1, delta)


def test_plan_transition_grain_leaves_out_the_end(spark):
    # two cycles of a schedule with equal start and different ends are one row: 140 - 30
    early, late = cycle(1, "2025-12-01", 1000, sched=11, disc=upfront(100.0)), list(cycle(1, "2025-12-01", 1000, sched=11, disc=upfront(40.0)))
    late[7] += dt.timedelta(days=10)
    p = plan_of(
        spark,
        items=[item(1, 7)], schedules=[term(11, "2025-07-01", 6), term(12, "2026-01-01", 12)],
        recognitions=[early, tuple(late), cycle(1, "2026-01-01", 1000, sched=12, disc=upfront(30.0))],
        discounts=[(1, "UPFRONT")],
    )
    assert component(p, "R16")[2] == (1, 1, 110.0)


def test_plan_of_1_3_12_months(spark):
    # upfront 0 / 20 / 25: the first cycle has no upfront line, so only the second change fires (20 - 25)
    both = '[{"amount":%s,"catalogReferenceId":"1"},{"amount":%s,"catalogReferenceId":"2"}]'
    p = plan_of(
        spark,
        items=[item(1, 7)], schedules=[term(11, "2025-11-01", 1), term(12, "2025-12-01", 3), term(13, "2026-01-01", 12)],
        recognitions=[cycle(1, "2025-11-01", 100, sched=11, disc='[{"amount":10,"catalogReferenceId":"2"}]'),
                      cycle(1, "2025-12-01", 80, sched=12, disc=both % (20, 10)), cycle(1, "2026-01-01", 70, sched=13, disc=both % (25, 15))],
        discounts=[(1, "UPFRONT"), (2, "LOYALTY")],
    )
    assert component(p, "R16") == {2: (1, 1, -5.0)}


def test_discount_change_in_the_current_month(spark):
    p = plan_of(
        spark, replace(POLICY, discount_change_months=0),
        items=[item(1, 7)],
        recognitions=[cycle(1, "2025-12-01", 1000, disc='[{"amount":200.0,"catalogReferenceId":"2"}]'),
                      cycle(1, "2026-01-01", 1000, disc='[{"amount":350.0,"catalogReferenceId":"2"}]')],
        discounts=[(2, "LOYALTY")],
    )
    assert component(p, "R23") == {1: (1, 1, -150.0)}


# ---- minimum-tenure scenarios and add-on services -----------------------------------


@pytest.mark.parametrize("asked,month,charged", [("2026-01-20", 1, -200.0), ("2026-02-20", 2, -100.0)])
def test_return_inside_the_tenure(spark, asked, month, charged):
    # cycles of 100 from mid January, February and March; a return recognises the later ones early
    rec = asked + " 06:00:00"
    starts = ("2026-01-15", "2026-02-15", "2026-03-15")
    p = plan_of(spark, items=[item(1, 7)], recognitions=[cycle(1, s, 100, rec=rec if s > asked else None) for s in starts])
    assert component(p, "R14")[month] == (-1, -1, charged)
    if month == 1:
        p = plan_of(spark, items=[item(1, 7)], recognitions=[cycle(1, s, 100, rec=rec if s > asked else None) for s in starts])
        assert component(p, "R02")[2] == (-1, -1, charged)


def test_cycle_inside_its_month_is_skipped(spark):
    # recognised early in December: the cycle of December itself is no future cycle (a known gap)
    policy = replace(POLICY, months=(dt.date(2025, 12, 1), dt.date(2026, 1, 1)))
    rec = "2025-12-12 12:03:00"
    p = plan_of(spark, policy, items=[item(1, 7)], recognitions=[
        cycle(1, "2025-11-08", 100, rec="2025-12-07 13:30:00"), cycle(1, "2025-12-08", 100, rec=rec), cycle(1, "2026-01-08", 100, rec=rec)])
    assert component(p, "R14")[1] == (-1, -1, -100.0)


def test_prefixed_service_types_and_labels(spark):
    policy = replace(POLICY, labels=(("R24", "Care of the brand"),))
    vas = [(70 + n, 1, "ITEM", t, "ACTIVE") for n, t in enumerate(("BRAND_CARE_PROGRAM", "FLEXI_CANCELLATION", "X_DELIVERY_CHARGE", "CARE_PROGRAMME"))]
    rows = dict(items=[item(1, 7)], vas=vas, recognitions=[cycle(70 + n, "2026-01-05", 10 ** n, etype="VALUE_ADDED_SERVICE") for n in range(4)])
    assert component(plan_of(spark, policy, **rows), "R24") == {1: (2, 1, 11.0)}
    assert component(plan_of(spark, policy, **rows), "R25") == {1: (1, 1, 100.0)}
    assert component(plan_of(spark, policy, **rows), "R27") == {1: (1, 1, 1000.0)}
    agg = assemble.aggregate_components(plan_of(spark, policy, **rows).rows("R24"), policy.labels)
    assert [r.label for r in agg.collect()] == ["Care of the brand"]


# ---- run variants ---------------------------------------------------------------------


@pytest.mark.parametrize("months,change", [(None, {2: (1, 1, -150.0)}), (5, {2: (1, 1, -150.0)}), (4, {})])
def test_discount_lookback(spark, months, change):
    # the cycle before starts in August, five months before the first month
    p = plan_of(
        spark, replace(POLICY, discount_lookback_months=months),
        items=[item(1, 7)],
        recognitions=[cycle(1, "2025-08-01", 1000, disc='[{"amount":200.0,"catalogReferenceId":"2"}]'),
                      cycle(1, "2026-01-01", 1000, disc='[{"amount":350.0,"catalogReferenceId":"2"}]')],
        discounts=[(2, "LOYALTY")],
    )
    assert component(p, "R21") == change


def test_opening_recognised_in_another_month(spark):
    # of four December cycles the one recognised in December is no opening of January; one is never recognised
    never = list(cycle(4, "2025-12-10", 40))
    never[8] = None
    rows = [cycle(1, "2025-12-05", 1, rec="2025-12-20 08:00:00"), cycle(2, "2025-12-05", 20, rec="2025-11-20 08:00:00"),
            cycle(3, "2025-12-05", 30, rec="2026-01-02 08:00:00"), tuple(never)]
    p = plan_of(spark, replace(POLICY, s11_recognised_rule="other_month"), items=[item(i, 6 + i) for i in (1, 2, 3, 4)], recognitions=rows)
    assert component(p, "R01")[1] == (3, 3, 90.0)


@pytest.mark.parametrize("rank,out,into", [
    ("event", {1: (-1, 0, -100.0), 2: (-1, 0, -300.0)}, {1: (1, 0, 300.0), 2: (1, 0, 500.0)}),
    ("entity", {2: (-1, 0, -300.0)}, {1: (1, 0, 300.0)}),
])
def test_one_swap_per_entity_and_action(spark, rank, out, into):
    # swapped out and in twice; the last way out and the first way in count
    p = plan_of(
        spark, replace(POLICY, swap_rank=rank),
        items=[item(1, 7), item(2, 7)],
        recognitions=[cycle(i, day, amount) for i in (1, 2) for day, amount in (("2026-01-01", 100), ("2026-02-01", 300), ("2026-03-01", 500))],
        swap_items=[(1, *swap(1, "SWAP_OUT", "2026-01-12 05:00:00")[1:]), (2, *swap(1, "SWAP_OUT", "2026-02-12 05:00:00")[1:]),
                    (3, *swap(2, "SWAP_IN", "2026-01-12 05:00:00")[1:]), (4, *swap(2, "SWAP_IN", "2026-02-12 05:00:00")[1:])],
    )
    assert {m: v for m, v in component(p, "R12").items() if v[0]} == out
    assert {m: v for m, v in component(p, "R13").items() if v[0]} == into


def test_labels_of_a_trailing_year_and_of_a_published_churn_table(spark):
    # one item kept all year, one returned in June, cycles recognised when they are over
    after = lambda s: str(dt.date.fromisoformat(s) + dt.timedelta(days=30)) + " 08:00:00"
    starts = [f"2025-{m:02d}-05" for m in range(1, 13)]
    p = plan_of(
        spark,
        items=[item(1, 7, act="2024-12-01 10:00:00"), item(2, 8, act="2024-12-01 10:00:00", pickup="2025-06-20 06:00:00")],
        recognitions=[cycle(1, s, 100, rec=after(s)) for s in starts] + [cycle(2, s, 50, rec=after(s)) for s in starts[:6]],
        return_items=[returned(2, 8, "2025-06-15")],
    )
    year = trailing_months(dt.date(2025, 12, 31))
    assert (len(year), year[0], year[-1]) == (12, dt.date(2025, 1, 1), dt.date(2025, 12, 1))
    policy = replace(POLICY, months=year)
    months = rolling_month_driver(spark, dt.date(2025, 12, 31))
    inline = cycles.labelling_pipeline(p.L, policy, months, p.churn["tagged"], terminal=True, stage=p.stage)
    table = cycles.labelling_pipeline(p.L, policy, months, None, terminal=True, stage=p.stage, churn_table=p.churn_table)
    rows = {k: sorted((r.entity_id, r.cycle_start_date, r.matched_month_window, r.primary_cycle_type) for r in cycles.cycle_history(f["L09"], policy).collect())
            for k, f in (("inline", inline), ("table", table))}
    assert rows["inline"] == rows["table"]
    assert Counter((e, label) for e, _, _, label in rows["table"]) == {(1, "NORMAL_CYCLE"): 11, (2, "NORMAL_CYCLE"): 5, (2, "CHURN_FULL"): 1}
