"""What a query reads, deals out and stages: the steps that grew faster than the input."""
import datetime as dt
import re
from decimal import Decimal

from revbridge.operators import base, churn, cycles, discount_shapes, discounts, swaps
from revbridge.plans.bridge import BridgePlan
from revbridge.plans.months import month_driver
from revbridge.policy import Policy
from revbridge.sources.ledger import Ledger

POLICY = Policy(months=(dt.date(2026, 1, 1), dt.date(2026, 2, 1)), as_of=dt.date(2026, 6, 1))


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")  # whole schemas
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column):
    """Scans that read a column."""
    return [s for s in re.findall(r"ReadSchema: struct<([^>]*)", plan_of(df)) if f"{column}:" in s]


class Stage:
    def __init__(self):
        self.frames = []

    def __call__(self, df):
        self.frames.append(df)
        return df


def at(text):
    return dt.datetime.fromisoformat(text)


def cycle(entity, start, amount=10, sched=None, disc=None):
    s = at(start)
    return (entity or 0, entity, "ITEM", "ACCRUAL", "RECOGNISED", "RENTAL", s, s + dt.timedelta(days=29), s, s, None, "ORDER", 1, sched, Decimal(amount), disc)


def on_disk(spark, tmp_path, **rows):
    Ledger.from_rows(spark, **rows).write_parquet(str(tmp_path))
    return BridgePlan(spark, Ledger.from_parquet(spark, str(tmp_path)), POLICY, materialize="none")


def test_churn_frames_that_nobody_asks_for_are_not_staged(spark):
    stage = Stage()
    frames = churn.churn_pipeline(Ledger.from_rows(spark), POLICY, stage, stage)
    churn.user_item_cross(frames["transactions"])
    assert len(stage.frames) == 1  # C02 reads the transactions alone
    assert frames["transactions"] is frames["transactions"] and len(stage.frames) == 1


def test_labels_over_every_cycle_stage_no_months(spark):
    L, stage = Ledger.from_rows(spark), Stage()
    tagged = spark.createDataFrame([], "item_ids long, composite_item_id long, user_ids long, transaction_type string, churn_flag string")
    frames = cycles.labelling_pipeline(L, POLICY, month_driver(spark, POLICY.months), tagged, stage=stage)
    frames["L03"]
    assert stage.frames == []
    frames["L07"], frames["L10"]
    assert len(stage.frames) == 2


def test_fault_lists_are_read_once(spark, tmp_path):
    plan = on_disk(spark, tmp_path, recognitions=[cycle(1, "2026-01-05", disc='{"amount": "x"}')])
    faults = discount_shapes.discount_faults(plan.split["entity"])
    assert len(scans(faults, "discounts")) == 1
    assert sorted((r.line, r.reason, r.fragment) for r in faults.collect() if r.line is not None) == [(0, "amount is no number", '{"amount":"x"}'), (0, "no catalog reference", '{"amount":"x"}')]
    assert [(r.reason, r.fragment) for r in faults.collect() if r.line is None] == [("object instead of a list", '{"amount": "x"}')]


def test_a_swap_match_reads_the_cycles_once(spark, tmp_path):
    plan = on_disk(spark, tmp_path, recognitions=[cycle(i, f"2026-01-{d}", a) for i, d, a in ((1, "03", 5), (1, "10", 7), (1, "10", 9), (1, "20", 1), (2, "15", 3), (None, "01", 8))])
    events = spark.createDataFrame(
        [(1, "ITEM", a, dt.date(2026, 1, d)) for a, d in (("SWAP_OUT", 10), ("SWAP_IN", 10), ("SWAP_IN", 21), ("SWAP_OUT", 2), ("SWAP_IN", 11))] + [(2, "ITEM", "SWAP_OUT", dt.date(2026, 1, 16)), (3, "ITEM", "SWAP_IN", dt.date(2026, 1, 1))],
        "entity_id long, entity_type string, action string, fulfillment_date date",
    )
    matches = swaps.swap_matches(events, plan.split["entity"])
    assert len(scans(matches, "accountable_entity_id")) == 1
    assert sorted((r.entity_id, r.action, r.fulfillment_date.day, r.taxable_amount and int(r.taxable_amount)) for r in matches.collect()) == [
        (1, "SWAP_IN", 10, 9), (1, "SWAP_IN", 11, 1), (1, "SWAP_IN", 21, None), (1, "SWAP_OUT", 2, None), (1, "SWAP_OUT", 10, 9), (2, "SWAP_OUT", 16, 3), (3, "SWAP_IN", 1, None),
    ]


def test_swaps_of_the_months_are_staged(spark):
    with BridgePlan(spark, Ledger.from_rows(spark), POLICY) as plan:
        plan.swap_matches
        assert "folder" in plan.__dict__


def test_discounts_are_read_once_before_and_once_in_the_window(spark, tmp_path):
    line = '[{"amount": %s, "catalogReferenceId": "%s"}]'
    rows = [cycle(1, "2025-01-05", sched=7, disc=line % (5, 1)), cycle(1, "2025-06-05", disc=None), cycle(1, "2026-01-05", sched=8, disc=line % (9, 1)),
            cycle(2, "2025-06-05", disc=line % (3, 1)), cycle(3, "2026-01-06", disc=line % (4, 99)), cycle(None, "2026-01-07"), cycle(None, "2025-01-07")]
    plan = on_disk(spark, tmp_path, recognitions=rows, discounts=[(1, "UPFRONT"), (None, "UPFRONT")])
    stage = Stage()
    found = discounts.recent_cycle_discounts(plan.L, POLICY, plan.split["entity"], stage)
    assert len(scans(found, "discounts")) == 2 and len(stage.frames) == 1
    key = lambda r: (r.accountable_entity_id or 0, r.rr_start_date, r.upfront_lines, int(r.upfront_amount), r.other_lines, int(r.other_amount))
    day = dt.date
    # the cycle before by upfront discounts and the one by other discounts; entity 2 has no cycle in the window
    assert sorted(map(key, found.collect())) == [
        (0, day(2026, 1, 7), 0, 0, 1, 0), (1, day(2025, 1, 5), 1, 5, 0, 0), (1, day(2025, 6, 5), 0, 0, 1, 0), (1, day(2026, 1, 5), 1, 9, 0, 0), (3, day(2026, 1, 6), 0, 0, 1, 4),
    ]


def test_only_entities_of_the_months_are_grouped_by_schedule(spark, tmp_path):
    sched = lambda i, start: (i, at(start), at(start) + dt.timedelta(days=90), Decimal(90), Decimal(100))
    rows = [cycle(1, "2025-01-05", sched=1), cycle(1, "2026-01-05", sched=2), cycle(2, "2025-01-05", sched=1), cycle(None, "2026-01-05", sched=2), cycle(None, "2025-01-05", sched=1), cycle(3, "2026-01-05")]
    plan = on_disk(spark, tmp_path, recognitions=rows, schedules=[sched(1, "2025-01-01"), sched(2, "2026-01-31 23:00:00"), sched(3, "2026-03-01")])
    stage = Stage()
    found = base.recent_grain(plan.L, POLICY, plan.split["entity"], stage)
    assert len(stage.frames) == 2 and {r.accountable_entity_id if "accountable_entity_id" in r else r["_id"] for r in stage.frames[1].collect()} == {1, None}
    shape = lambda df: sorted((r.accountable_entity_id or 0, r.revenue_recognition_schedule_id) for r in df.collect())
    assert shape(found) == shape(base.recent_grain(plan.L, POLICY, plan.split["entity"])) == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_discount_groups_are_dealt_out_before_lines_are_taken_apart(spark, tmp_path):
    text = '[{"amount": 1.5}, {"amount": 2}]'
    plan = on_disk(spark, tmp_path, recognitions=[cycle(1, "2026-01-05", disc=text)] * 3 + [cycle(1, "2026-01-05"), cycle(None, "2026-01-05", disc="bad")])
    check = discounts.discount_grain_check(plan.scheduled)
    steps = plan_of(check)
    assert steps.index("Generate") < steps.index("REPARTITION_BY_NUM")  # the plan lists the last step first
    assert "HashAggregate" not in steps[steps.index("Generate"):]
    got = sorted((r.n_cycles, float(r.json_total), float(r.exploded_total), r.matches) for r in check.collect())
    assert got == [(1, 0.0, 0.0, True), (1, 0.0, 0.0, True), (3, 10.5, 10.5, True)]


def test_churn_of_the_months_takes_their_users_only(spark):
    from tests.test_churn_bruteforce import rand_ledger

    day = dt.timedelta(days=1)
    for seed in range(1):
        L = rand_ledger(spark, seed)
        whole = churn.churn_pipeline(L, POLICY, lambda df: df.checkpoint())
        paid = sorted({r.payment_date.date() for r in whole["tagged"].filter("payment_date IS NOT NULL").collect()})
        policy = Policy(months=(paid[len(paid) // 2].replace(day=1),), as_of=POLICY.as_of)
        ids = {r.item_ids for r in whole["tagged"].collect() if r.payment_date and policy.first_start <= r.payment_date.date() <= policy.last_next - day}
        stage = Stage()
        got = churn.tagged_of_months(L, policy, churn.item_transactions(L, policy).checkpoint(), lambda df: stage(df.checkpoint()))
        assert ids and sorted(map(str, got.collect())) == sorted(str(r) for r in whole["tagged"].select(got.columns).collect() if r.item_ids in ids)


def test_items_of_other_users_stay_out_of_the_sweeps(spark):
    item = lambda i, user: (i, user, i, "ACTIVE", "RENTAL", at("2025-01-01"), None, i, "x", None)
    back = lambda i, trans, day: (i, i, trans, "COMPLETED", at(day), at(day))
    # 1 and 3 share a return of the months; 2 is of the same user as 1, 4 of the same as 3; 5 and 6 are returned at other times
    L = Ledger.from_rows(
        spark, items=[item(1, 10), item(2, 10), item(3, 20), item(4, 20), item(5, 30), item(6, 30)],
        return_items=[back(1, 7, "2026-01-05"), back(3, 7, "2025-12-01"), back(5, 8, "2025-11-01"), back(6, 9, "2026-04-01")],
    )
    stage = Stage()
    got = churn.tagged_of_months(L, POLICY, churn.item_transactions(L, POLICY).checkpoint(), lambda df: stage(df.checkpoint()))
    assert {r.item_ids for r in got.collect()} == {1}
    taken = [f for f in stage.frames if "later_items_count" not in f.columns and "item_ids" in f.columns]
    assert len(taken) == 1 and {r.item_ids for r in taken[0].collect()} == {1, 2, 3, 4}


def test_latest_cycles_are_read_in_one_scan(spark, tmp_path):
    rows = [cycle(1, "2025-12-05", 30), cycle(1, "2026-01-05", 60), cycle(1, "2026-01-05", 90)]
    plan = on_disk(spark, tmp_path, recognitions=rows)
    columns = ["item_ids", "composite_item_id", *churn.KEEP]
    churned = spark.createDataFrame([(i, None, *[None] * len(churn.KEEP)) for i in (1, 2)], ", ".join(f"{c} {'long' if 'id' in c else 'string'}" for c in columns))
    found = churn.latest_cycles(plan.L, POLICY, churned)
    assert sorted((r.entity_id, r.taxable_amount and int(r.taxable_amount)) for r in found.collect()) == [(1, 60), (1, 90), (2, None)]
    stage = Stage()
    churn.latest_cycles(plan.L, POLICY, churned, stage)
    assert len(stage.frames) == 2 and len(scans(stage.frames[1], "taxable_amount")) == 1


def test_opening_leaves_out_cycles_that_no_month_can_tag(spark, tmp_path):
    bought = dict(rtp_items=[(1, 3, 1, "PAID", None)], rtp_orders=[(1, "CONFIRMED", at("2026-02-10"))])
    rows = [cycle(1, "2026-01-05"), cycle(2, "2027-05-05"), cycle(3, "2027-05-05"), cycle(None, "2027-05-05")]
    plan = on_disk(spark, tmp_path, recognitions=rows, **bought)
    assert {(r.accountable_entity_id, str(r.start_date)) for r in plan.opening_cycles.collect()} == {(1, "2026-01-05"), (3, "2027-05-05")}
    assert {(r.month_num, r.tag, r.accountable_entity_id) for r in plan.classified.collect()} == {(2, "S1.1", 1), (2, "CMTP", 3)}
