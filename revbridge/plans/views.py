"""SQL surface: the products of a plan as temporary views, asked with named parameters.

`publish` registers the products under their names; `ask` runs one of the statements below
(or any other) over them.  Values go in as parameters of `spark.sql`, never into the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from revbridge.operators import assemble, cycles, discounts, reconcile
from revbridge.plans.bridge import BridgePlan

PRODUCTS: dict[str, Callable[[BridgePlan], DataFrame]] = {
    "revenue_bridge": lambda p: p.report(),
    "bridge_components": lambda p: assemble.all_components(p.aggregated, p.policy.labels),
    "bridge_rows": lambda p: p.bridge_rows,
    "bridge_gap": lambda p: reconcile.gap_drilldown(p.bridge_rows, len(p.policy.months)),
    "churn_table": lambda p: p.churn_table,
    "churn_events": lambda p: p.churn_events,
    "classified_cycles": lambda p: p.classified,
    "plan_transitions": lambda p: discounts.plan_transition_detail(p.cycle_discounts, p.months, p.policy),
    "cycle_history": lambda p: cycles.cycle_history(
        cycles.labelling_pipeline(p.L, p.policy, p.months, p.churn["tagged"], stage=p.stage)["L09"], p.policy
    ),
}

#: Statements over the views; every value is a parameter.
STATEMENTS = {
    "report": "SELECT * FROM {prefix}revenue_bridge ORDER BY sort_order, component",
    "component": "SELECT * FROM {prefix}bridge_rows WHERE component = :component AND (:month_num IS NULL OR month_num = :month_num)",
    "history": "SELECT * FROM {prefix}cycle_history WHERE (:entity_id IS NULL OR entity_id = :entity_id) AND (:entity_type IS NULL OR entity_type = :entity_type)",
    "transitions": """SELECT * FROM {prefix}plan_transitions
        WHERE (:entity_id IS NULL OR accountable_entity_id = :entity_id) AND (:entity_type IS NULL OR accountable_entity_type = :entity_type)""",
    "gap": "SELECT * FROM {prefix}bridge_gap WHERE (:cause IS NULL OR cause = :cause)",
}
PARAMETERS = {"report": (), "component": ("component", "month_num"), "history": ("entity_id", "entity_type"), "transitions": ("entity_id", "entity_type"), "gap": ("cause",)}


def publish(plan: BridgePlan, names: list[str] | None = None, prefix: str = "") -> list[str]:
    """Register the products (all, or those named) as temporary views; their names."""
    if not prefix.replace("_", "").isalnum() and prefix:
        raise ValueError("a prefix has letters, digits and underscores only")
    views = []
    for name in names or list(PRODUCTS):
        PRODUCTS[name](plan).createOrReplaceTempView(f"{prefix}{name}")
        views.append(f"{prefix}{name}")
    return views


def ask(plan: BridgePlan, statement: str, prefix: str = "", **values) -> DataFrame:
    """The result of a named statement; parameters that are not given are NULL (no condition)."""
    unknown = set(values) - set(PARAMETERS[statement])
    if unknown:
        raise TypeError(f"{statement} has no parameters {sorted(unknown)}")
    return plan.spark.sql(STATEMENTS[statement].format(prefix=prefix), args={p: values.get(p) for p in PARAMETERS[statement]})
