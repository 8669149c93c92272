"""Registered queries: one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole bound
ledger.  `present` gives every result the same, engine-neutral shape (temporal
columns as ISO strings, decimals as double, integers as bigint) so results can
be compared value by value with the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revbridge.operators import assemble, base, churn, cycles, discount_shapes, discounts, distinct, movements, periods, reconcile, swaps, vas
from revbridge.operators.base import ENTITY_KEYS
from revbridge.plans import views
from revbridge.plans.bridge import BridgePlan
from revbridge.plans.months import rolling_month_driver, trailing_months
from revbridge.policy import FAMILIES, Policy
from revbridge.sources.churn_store import ChurnStore
from revbridge.sources.tpch_binding import close_ledgers, fixture_policy, ledger_for, table_times

_PLANS: dict = {}


def plan_for(spark: SparkSession, sf_dir: str, policy: Policy | None = None) -> BridgePlan:
    """One plan per session, folder (and state of its tables) and policy: the
    registered queries of a run share its ledger and its staged frames."""
    policy = policy or fixture_policy()
    key = (spark.sparkContext.applicationId, sf_dir, table_times(spark, sf_dir), policy)
    if key not in _PLANS:
        _PLANS[key] = BridgePlan(spark, ledger_for(spark, sf_dir, policy), policy)
    return _PLANS[key]


def close_plans() -> None:
    """Delete what the registered queries have staged."""
    while _PLANS:
        _PLANS.popitem()[1].close()
    _LABELS.clear()
    close_ledgers()


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _component(comp: str) -> Callable[[SparkSession, str], DataFrame]:
    """Per-month items / customers / revenue of one bridge component, as the
    report computes it (zero rows for members of a shared frame): only the
    frames of its own family are computed."""
    def run(spark, sf_dir):
        p = plan_for(spark, sf_dir)
        members = next((m for m in FAMILIES.values() if comp in m), [])
        if members:
            agg = assemble.all_components(assemble.aggregate_components(p.families(members)))
        else:
            agg = assemble.aggregate_components(p.rows(comp))
        return agg.filter(F.col("component") == comp).select(
            "month_num", "items_count", "cx_count", "taxable_revenue"
        )
    return run


def _cycles_per_month(months: DataFrame, L) -> DataFrame:
    starts = L.recognitions.select(F.trunc(F.to_date("start_date"), "month").alias("m_start"))
    counts = starts.groupBy("m_start").agg(F.count(F.lit(1)).alias("cycles_starting"))
    return months.join(counts, "m_start", "left").select(
        "month_num", "m_start", "m_next", "m_end", "prev_start", "m_label",
        F.coalesce("cycles_starting", F.lit(0)).alias("cycles_starting"),
    )


def q_b01(s, d):
    return base.entity_directory(plan_for(s, d).L)


def q_b02(s, d):
    return plan_for(s, d).base.select(
        "recognition_type", "accountable_entity_id", "accountable_entity_type", "rr_start_date", "rr_end_date",
        "recognised_at_ist", "created_at_ist", "external_reference_type", "revenue_recognition_schedule_id",
        "taxable_amount", "sched_taxable_amount", "sched_tenure",
    )


def q_b03(s, d):
    parts = plan_for(s, d).split
    out = None
    for name, df in parts.items():
        g = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("taxable_amount").alias("taxable_amount")).select(
            F.lit(name).alias("slice"), "n_rows", "taxable_amount"
        )
        out = g if out is None else out.unionByName(g)
    return out


def q_b04(s, d):
    return plan_for(s, d).cycles


def q_b05(s, d):
    return plan_for(s, d).buyouts


def q_b06(s, d):
    return plan_for(s, d).effective


def q_b07(s, d):
    p = plan_for(s, d)
    return _cycles_per_month(p.months, p.L)


def q_b08(s, d):
    p = plan_for(s, d)
    return _cycles_per_month(rolling_month_driver(s, p.policy.as_of, 12), p.L)


def q_b09(s, d):
    return plan_for(s, d).grain


def q_b10(s, d):
    return base.first_completed_return(plan_for(s, d).L)


def q_b11(s, d):
    p = plan_for(s, d)
    return base.normalised_cycles(p.L, p.policy, p.base)


def q_c01(s, d):
    return plan_for(s, d).churn["transactions"]


def q_c02(s, d):
    return churn.user_item_cross(plan_for(s, d).churn["transactions"])


def q_c03(s, d):
    return plan_for(s, d).churn["scope"]


def q_c04(s, d):
    return plan_for(s, d).churn["detail"]


def q_c05(s, d):
    return plan_for(s, d).churn["counts"]


def q_c06(s, d):
    return plan_for(s, d).churn["tagged"].select("item_ids", "user_ids", "pickup_date", "later_items_count", "churn_flag")


AMOUNT_COLS = ["entity_id", "entity_type", "churn_flag", "transaction_type", "payment_date", "start_date", "end_date",
               "taxable_amount", "revenue_loss_month", "revenue_loss_day", "rnk"]


def q_c07(s, d):
    return plan_for(s, d).churn["item_amounts"].select(*AMOUNT_COLS)


def q_c08(s, d):
    return plan_for(s, d).churn["attachment_amounts"].select(*AMOUNT_COLS)


def q_c09(s, d):
    return plan_for(s, d).churn_table.select(
        "entity_id", "entity_type", "user_ids", "activation_date", "return_item_state", "base_price", "fur_id",
        "pickup_date", "payment_date", "tto_amount", "transaction_type", "transaction_id", "transaction_type_detail", "churn_flag",
        "start_date", "end_date", "taxable_amount", "rnk", "refreshed_at",
    )


def q_r00(s, d):
    return plan_for(s, d).classified.select(
        "month_num", "tag", "accountable_entity_id", "accountable_entity_type", "start_date", "recognised_at",
        "synthetic_recognised_at", "user_id", "taxable_amount",
    )


def q_r03(s, d):
    return assemble.adjusted_opening(plan_for(s, d).aggregated)


def q_r0x(s, d):
    return plan_for(s, d).mtp


def q_r0c(s, d):
    return _events(plan_for(s, d).churn_events)


def _events(df):
    return df.select(
        "month_num", "entity_id", "entity_type", F.col("customer").cast("long").alias("user_ids"),
        F.col("amount").alias("taxable_amount"), "churn_flag", "transaction_type",
    )


def q_r0n(s, d):
    p = plan_for(s, d)
    aware = replace(p.policy, mtp_exclusion="not_in")
    return _events(movements.month_churn_events(p.L, p.month_tagged, p.mtp, p.months, aware, p.stage))


def _published(s, p):
    """The plan's churn table, published once and read back."""
    store = ChurnStore(f"{p.folder.path}/churn-table")
    if not store.versions(s):
        store.publish(p.churn_table)
    return store.read(s, refreshed_at=p.policy.as_of)


def q_c10(s, d):
    p = plan_for(s, d)
    return _events(movements.churn_events(_published(s, p), p.mtp, p.months, p.policy))


def q_r28(s, d):
    return plan_for(s, d).vas_timing


def q_r29(s, d):
    return vas.vas_bridge(plan_for(s, d).vas_timing)


def q_r30(s, d):
    p = plan_for(s, d)
    return vas.vas_adjusted_opening(assemble.adjusted_opening(p.aggregated), vas.vas_bridge(p.vas_timing))


def q_a01(s, d):
    return assemble.all_components(plan_for(s, d).aggregated).select(
        "month_num", F.col("label").alias("component"), "sort_order", "items_count", "cx_count", "taxable_revenue"
    )


def q_a02(s, d):
    return assemble.bridge_wide(q_a01(s, d))


def q_a03(s, d):
    agg = plan_for(s, d).aggregated
    return assemble.closing(agg, assemble.adjusted_opening(agg))


def q_a04(s, d):
    agg = plan_for(s, d).aggregated
    return assemble.bridge_gap(agg, assemble.closing(agg, assemble.adjusted_opening(agg))).filter(F.col("month_num") == 1)


def q_a06(s, d):
    p = plan_for(s, d)
    rows = p.bridge_rows.filter(F.col("component").isin(*sorted({c for lists in (distinct.HELD, distinct.LEFT) for c in sum(lists.values(), [])})))
    closing = assemble.closing(p.aggregated, assemble.adjusted_opening(p.aggregated))
    return distinct.distinct_closing(distinct.distinct_sets(p.stage(rows), p.stage), closing)


def q_a05(s, d):
    return plan_for(s, d).report()


def q_q01(s, d):
    return assemble.component_drilldown(plan_for(s, d).bridge_rows)


def q_q02(s, d):
    p = plan_for(s, d)
    return reconcile.gap_drilldown(p.bridge_rows, len(p.policy.months))


def q_q03(s, d):
    return reconcile.gap_causes(q_q02(s, d))


def q_d01(s, d):
    return discounts.discount_lines(plan_for(s, d).scheduled)


def q_d02(s, d):
    return plan_for(s, d).typed_discounts


def q_d03(s, d):
    return discounts.upfront_per_schedule(plan_for(s, d).typed_discounts)


def q_d04(s, d):
    return discounts.discount_per_schedule(plan_for(s, d).typed_discounts)


def q_d05(s, d):
    p = plan_for(s, d)
    return discounts.plan_transition_detail(p.cycle_discounts, p.months, p.policy)


def q_d06(s, d):
    return discounts.discount_grain_check(plan_for(s, d).scheduled)


#: Fiscal year of the registered query: twelve periods of 4, 4 and 5 weeks.
FISCAL_START = dt.date(1996, 12, 30)


def q_p01(s, d):
    p, fiscal = plan_for(s, d), periods.week_pattern(FISCAL_START)
    recent = p.live.filter(F.col("rr_start_date") >= F.lit(fiscal[0].previous))  # no rule looks further back
    cycles_ = base.effective_recognition_date(base.revenue_cycles(p.L, p.policy, recent), p.buyouts)
    return periods.period_revenue(periods.classify_periods(cycles_, fiscal, p.policy))


def q_d07(s, d):
    faults = discount_shapes.discount_faults(plan_for(s, d).split["entity"])
    return faults.select(*ENTITY_KEYS, "revenue_recognition_schedule_id", F.to_date("rr_start_date").alias("start_date"), "line", "reason")


def _asked(view: str, statement: str, **values):
    """A product through its SQL view and named parameters."""
    def run(s, d):
        p = plan_for(s, d)
        views.publish(p, [view], prefix="registered_")
        return views.ask(p, statement, prefix="registered_", **values)
    return run


def q_s01(s, d):
    return swaps.swap_register(plan_for(s, d).L)


def q_s02(s, d):
    p = plan_for(s, d)
    return swaps.swap_peers(swaps.swap_events(p.L), p.split["entity"])


def q_s03(s, d):
    p = plan_for(s, d)
    return swaps.swap_matches(swaps.one_swap_per_action(swaps.swap_events(p.L)), p.split["entity"])


_LABELS: dict = {}


def labelling(s, d) -> dict[str, DataFrame]:
    p = plan_for(s, d)
    key = (s.sparkContext.applicationId, d, table_times(s, d), p.policy)
    if key not in _LABELS:
        _LABELS[key] = cycles.labelling_pipeline(p.L, p.policy, p.months, p.churn["tagged"], stage=p.stage)
    return _LABELS[key]


CYC = ["accountable_entity_id", "accountable_entity_type", "cycle_start_date", "cycle_end_date"]


def q_l01(s, d):
    return labelling(s, d)["L01"].select(*CYC, "return_item_id", "return_item_state", "return_created_at_ist", "has_return_in_window")


def q_l02(s, d):
    return labelling(s, d)["L02"].select(*CYC, "rent_to_purchase_item_id", "rtp_created_at_ist", "has_rtp_in_window")


def q_l03(s, d):
    return labelling(s, d)["L03"].select(
        *CYC, "has_return_in_window", "has_rtp_in_window", "churn_classification", "churn_transaction_type", "churn_user_id"
    )


def q_l04(s, d):
    return labelling(s, d)["L04"].select(
        *CYC, "global_tto_date", "future_cycles_count", "synthetic_recognised_at_ist", "used_tto_date_for_pattern"
    )


def q_l05(s, d):
    return labelling(s, d)["L05"].select(*CYC, "month_num", "mtp_classification", "matched_month_window").distinct()


def q_l06(s, d):
    return labelling(s, d)["L06"].select(*CYC, "month_num", "mtp_classification", "matched_month_window")


def q_l07(s, d):
    return labelling(s, d)["L07"].select(*CYC, "primary_cycle_type")


def q_l07t(s, d):
    return labelling(s, d)["L07T"].select(*CYC, "primary_cycle_type")


def q_l08(s, d):
    return labelling(s, d)["L08"]


def q_l09(s, d):
    return labelling(s, d)["L09"].select(
        *CYC, "last_cycle_end_date", "item_recognition_pattern", "churn_pattern_type", "cycle_position_from_end",
        "is_item_last_cycle",
    )


def q_l10(s, d):
    return cycles.cycle_history(labelling(s, d)["L09"], plan_for(s, d).policy)


def q_l11(s, d):
    p = plan_for(s, d)
    return cycles.return_through_parent(cycles.labelling_cycles(p.L, p.policy), p.L).select(
        *CYC, "return_item_id", "return_item_state", "return_created_at_ist", "return_route", "returned_directly", "returned_with_parent", "has_return_in_window"
    )


#: Last day of the twelve months that L12 labels.
TRAILING_YEAR_END = dt.date(1997, 12, 31)


def q_l12(s, d):
    p = plan_for(s, d)
    policy = replace(p.policy, months=trailing_months(TRAILING_YEAR_END))
    pipe = cycles.labelling_pipeline(p.L, policy, rolling_month_driver(s, TRAILING_YEAR_END), p.churn["tagged"], stage=p.stage)
    return cycles.cycle_history(pipe["L09"], policy)


def q_l13(s, d):
    p = plan_for(s, d)
    pipe = cycles.labelling_pipeline(p.L, p.policy, p.months, None, terminal=True, stage=p.stage, churn_table=_published(s, p))
    return cycles.cycle_history(pipe["L09"], p.policy)


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "B01_entity_directory": q_b01,
    "B02_ledger_base": q_b02,
    "B03_ledger_split": q_b03,
    "B04_revenue_cycles": q_b04,
    "B05_buyout_dates": q_b05,
    "B06_effective_recognition_date": q_b06,
    "B07_month_driver": q_b07,
    "B08_rolling_month_driver": q_b08,
    "B09_schedule_grain": q_b09,
    "B10_first_completed_return": q_b10,
    "B11_normalised_cycles": q_b11,
    "C01_item_transactions": q_c01,
    "C02_user_item_cross": q_c02,
    "C03_transaction_scope": q_c03,
    "C04_transaction_detail": q_c04,
    "C05_remaining_item_count": q_c05,
    "C06_churn_flag": q_c06,
    "C07_item_churn_amount": q_c07,
    "C08_attachment_churn_amount": q_c08,
    "C09_churn_table": q_c09,
    "C10_published_churn_events": q_c10,
    "R00_classify_cycles": q_r00,
    "R01_opening_revenue": _component("R01"),
    "R02_mtp_adjustment": _component("R02"),
    "R03_adjusted_opening": q_r03,
    "R14_current_month_mtp": _component("R14"),
    "R0X_mtp_entities": q_r0x,
    "R04_new_deliveries": _component("R04"),
    "R05_upsells": _component("R05"),
    "R0C_churn_events": q_r0c,
    "R0N_churn_events_null_aware": q_r0n,
    "R06_total_pickups": _component("R06"),
    "R07_partial_pickups": _component("R07"),
    "R08_full_pickups": _component("R08"),
    "R09_buyout_total": _component("R09"),
    "R10_buyout_partial": _component("R10"),
    "R11_buyout_full": _component("R11"),
    "R12_swapped_out": _component("R12"),
    "R13_swapped_in": _component("R13"),
    "R15_penalty_revenue": _component("R15"),
    "R16_plan_transition": _component("R16"),
    "R16P_plan_transition_positive": _component("R16P"),
    "R17_plan_transition_negative": _component("R17"),
    "R18_renewal_overdue_positive": _component("R18"),
    "R19_renewal_overdue_negative": _component("R19"),
    "R20_discount_given": _component("R20"),
    "R21_discount_change": _component("R21"),
    "R22_discount_change_positive": _component("R22"),
    "R23_discount_change_negative": _component("R23"),
    "R24_vas_care_flexi": _component("R24"),
    "R25_vas_delivery": _component("R25"),
    "R26_vas_installation": _component("R26"),
    "R27_vas_other": _component("R27"),
    "R28_vas_timing_detail": q_r28,
    "R29_vas_bridge": q_r29,
    "R30_vas_adjusted_opening": q_r30,
    "A01_all_components": q_a01,
    "A02_bridge_wide": q_a02,
    "A03_closing_revenue": q_a03,
    "A04_bridge_gap": q_a04,
    "A05_revenue_bridge": q_a05,
    "A06_distinct_closing": q_a06,
    "Q01_component_drilldown": q_q01,
    "Q02_gap_drilldown": q_q02,
    "Q03_gap_causes": q_q03,
    "D01_discount_lines": q_d01,
    "D02_discount_types": q_d02,
    "D03_upfront_per_schedule": q_d03,
    "D04_discount_per_schedule": q_d04,
    "D05_plan_transition_detail": q_d05,
    "D06_discount_grain_check": q_d06,
    "D07_discount_faults": q_d07,
    "S01_swap_register": q_s01,
    "S02_swap_peers": q_s02,
    "S03_swap_one_per_action": q_s03,
    "L01_return_in_cycle": q_l01,
    "L02_buyout_in_cycle": q_l02,
    "L03_churn_enrichment": q_l03,
    "L04_lifecycle_context": q_l04,
    "L05_cycle_month_class": q_l05,
    "L06_earliest_match": q_l06,
    "L07_cycle_label": q_l07,
    "L07T_cycle_label_terminal": q_l07t,
    "L08_entity_context": q_l08,
    "L09_lifecycle_pattern": q_l09,
    "L10_cycle_history": q_l10,
    "L11_return_through_parent": q_l11,
    "L12_trailing_year_history": q_l12,
    "L13_history_from_churn_table": q_l13,
    "P01_fiscal_periods": q_p01,
    "V01_sql_report": _asked("revenue_bridge", "report"),
    "V02_sql_component": _asked("bridge_rows", "component", component="R14"),
    "V03_sql_transitions": _asked("plan_transitions", "transitions", entity_type="ITEM"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: (lambda spark, sf_dir: present(f(spark, sf_dir))))(fn) for name, fn in RAW.items()}
