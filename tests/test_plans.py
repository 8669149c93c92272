"""Plan shape of the registered queries before anything is staged: no nested-loop or cartesian joins,
no Python in the hot path, and ledger predicates and month bounds in the parquet scans."""
import re
from types import SimpleNamespace

import pytest

from revbridge.operators import cycles
from revbridge.plans.bridge import BridgePlan
from revbridge.plans.registry import plan_for, queries
from revbridge.session import RunFolder, checkpoint_dir
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython")


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")  # whole filter lists
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lazy(spark):
    """A plan that stages nothing: its frames show every scan and join."""
    return BridgePlan(spark, ledger_for(spark, SF), fixture_policy(), materialize="none")


def pushed(df, column):
    """PushedFilters of the scans that read a column."""
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(df))
    return [s for s in scans if column in s]


def test_no_pairwise_joins_or_python(spark):
    flagged = []
    for key, fn in queries().items():
        flagged += [(key, pat) for pat in FORBIDDEN if pat in plan_of(fn(spark, SF))]
    assert flagged == []


def test_unstaged_frames_have_no_pairwise_joins(lazy):
    for df in (lazy.churn["scope"], lazy.bridge_rows, lazy.cycle_discounts):
        assert not [pat for pat in FORBIDDEN if pat in plan_of(df)]


def test_ledger_filters_pushed_to_scan(lazy):
    assert all("EqualTo(vertical,RENTAL)" in s for s in pushed(lazy.cycles, "vertical")) and pushed(lazy.cycles, "vertical")


@pytest.mark.parametrize("component,column,low", [
    ("R01", "start_date", "1996-12-01"), ("R02", "start_date", "1996-12-01"), ("R14", "start_date", "1996-12-01"),
    ("R04", "activation_date", "1997-01-01"), ("R05", "activation_date", "1997-01-01"), ("R12", "fulfillment_date", "1996-12-31"),
    ("R13", "fulfillment_date", "1996-12-31"), ("R15", "recognised_at", "1996-12-31"), ("R24", "start_date", "1996-12-01"), ("R27", "start_date", "1996-12-01"),
])
def test_month_bounds_reach_the_scan(lazy, component, column, low):
    scans = pushed(lazy.rows(component), f"GreaterThanOrEqual({column},")
    assert scans and all(f"GreaterThanOrEqual({column},{low}" in s for s in scans)
    if component in ("R15", "R24", "R27", "R04", "R05", "R12", "R13"):
        assert all(f"LessThan({column},1997-03-0" in s for s in scans)


@pytest.mark.parametrize("component", ["R16", "R20", "R21", "R22", "R23"])
def test_every_discount_scan_has_a_start_bound(lazy, component):
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<([^>]*)", plan_of(lazy.rows(component)))
    cycles = [f for f, columns in scans if "discounts:" in columns]
    assert cycles and all("(start_date,1996-12-01" in f for f in cycles)


@pytest.mark.parametrize("components,windows", [(["R18", "R19"], 1), (["R16P", "R17"], 1)])
def test_a_family_is_computed_once(lazy, components, windows):
    plan = plan_of(lazy.families(components))
    assert plan.count("Window [") == windows
    assert len([s for s in pushed(lazy.families(components), "vertical")]) == 1


def test_only_the_months_churn_is_ranked(spark):
    plan = plan_of(plan_for(spark, SF).families(["R06", "R07"]))  # the churned rows are staged
    assert "dense_rank" not in plan and not [pat for pat in FORBIDDEN if pat in plan]


def test_cycle_labels_scan_the_months(lazy):
    context = cycles.month_context(lazy.L, lazy.policy)
    bounds = [f for f in pushed(context, "vertical") if "GreaterThanOrEqual(start_date,1996-12-01" in f and "GreaterThanOrEqual(recognised_at,1996-11-30" in f]
    assert len(bounds) == 1 and "Or(" in bounds[0]


def test_vas_timing_bounds(lazy):
    assert pushed(lazy.vas_timing, "GreaterThanOrEqual(start_date,1996-12-01")


def test_a_component_computes_only_its_own_frames(spark):
    plan = BridgePlan(spark, ledger_for(spark, SF), fixture_policy())
    plan.rows("R15")
    plan.rows("R04")
    assert "classified" not in plan.__dict__ and "folder" not in plan.__dict__


def test_a_run_leaves_nothing_behind(spark):
    with BridgePlan(spark, ledger_for(spark, SF), fixture_policy()) as plan:
        plan.report().collect()
        folder = plan.folder.path
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert fs.exists(path)
    assert not fs.exists(path)


def test_an_unset_shared_folder_is_an_error():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(bare)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        RunFolder(bare)
