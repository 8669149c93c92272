"""Products asked in SQL, with parameters."""
import pytest

from revbridge.plans import views
from revbridge.plans.bridge import BridgePlan
from revbridge.sources.tpch_binding import fixture_policy, ledger_for


def bag(df):
    return sorted(map(str, df.collect()))


def test_statements_equal_the_api(spark):
    with BridgePlan(spark, ledger_for(spark, "/root/testdata/sf0.001"), fixture_policy()) as plan:
        assert set(views.publish(plan, ["revenue_bridge", "bridge_rows", "cycle_history"], prefix="t_")) == {"t_revenue_bridge", "t_bridge_rows", "t_cycle_history"}
        assert bag(views.ask(plan, "report", prefix="t_")) == bag(plan.report())
        assert bag(views.ask(plan, "component", prefix="t_", component="R04", month_num=1)) == bag(plan.rows("R04").filter("month_num = 1"))
        whole = plan.stage(views.PRODUCTS["cycle_history"](plan))
        some = whole.first()
        assert bag(views.ask(plan, "history", prefix="t_", entity_id=some.entity_id)) == bag(whole.filter(whole.entity_id == some.entity_id))
        assert views.ask(plan, "component", prefix="t_", component="R04' OR 'a' = 'a").collect() == []  # a value, not text
        with pytest.raises(TypeError):
            views.ask(plan, "report", prefix="t_", entity_id=1)
        with pytest.raises(ValueError):
            views.publish(plan, ["bridge_rows"], prefix="x; DROP")
