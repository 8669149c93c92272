"""Every Policy knob builds and runs the full report on the bound ledger."""
import datetime as dt

import pytest

from revbridge.plans.bridge import BridgePlan
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

SF = "/root/testdata/sf0.001"

VARIANTS = [
    fixture_policy(s11_recognised_rule="prev_start"),
    fixture_policy(s11_recognised_rule="month_start", current_mtp_date="raw"),
    fixture_policy(discount_population="all", include_settlement=False, plan_transition_dense=True),
    fixture_policy(vas_in_opening=True, churn_bucket="pickup", discount_change_months=0),
    fixture_policy(exclude_deleted=True, created_from=dt.date(1996, 6, 1)),
    fixture_policy(months=(dt.date(1996, 11, 1), dt.date(1996, 12, 1), dt.date(1997, 1, 1))),
]


@pytest.mark.parametrize("policy", VARIANTS, ids=range(len(VARIANTS)))
def test_variant_report_runs(spark, policy):
    with BridgePlan(spark, ledger_for(spark, SF), policy) as plan:
        rows = plan.report().collect()
    labels = {r.component for r in rows}
    assert "Opening_revenue" in labels and "Total closing Revenue" in labels
    assert all(r.sort_order is not None for r in rows)
