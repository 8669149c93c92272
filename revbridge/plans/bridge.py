"""The bridge plan: wires the operators into the report and names the cut
points where a frame is reused by several components.

Cut points (`materialize`):
  * "table"      - (default) parquet written once under the cluster's
                   `spark.checkpoint.dir` and read back: one job, survives
                   executor loss, and later scans prune columns / push filters
  * "persist"    - MEMORY_AND_DISK cache; lost blocks are recomputed from lineage
  * "checkpoint" - reliable checkpoint into the cluster's `spark.checkpoint.dir`
                   (survives executor loss without recomputing the lineage)
  * "none"       - fully lazy; Catalyst inlines everything into one plan

The ledger itself is not copied: consumers scan it with their own pruning
(and only discounts / the schedule grain pay the schedule join).  Cut frames:
the classified cycles (opening, MTP and the churn anti-join), the churn intermediates (transactions, item base,
tagged items), the typed discount lines and the component aggregate (months
x components rows read by every report line).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revbridge.operators import assemble, base, churn, classify, discounts, movements, swaps, transitions, vas
from revbridge.operators.movements import within
from revbridge.plans.months import month_driver
from revbridge.policy import Policy
from revbridge.session import RunFolder, checkpoint_dir
from revbridge.sources.churn_store import ChurnStore
from revbridge.sources.ledger import Ledger


class BridgePlan:
    """One run over a ledger.  `close` (or leaving its `with` block) deletes the
    run's intermediate tables.  With `churn_source`, a published churn table, the
    bridge reads that table instead of rebuilding churn."""

    def __init__(self, spark: SparkSession, ledger: Ledger, policy: Policy, materialize: str = "table", churn_source: ChurnStore | None = None):
        self.spark = spark
        self.churn_source = churn_source
        self.L = ledger
        self.policy = policy
        self.materialize = materialize

    @cached_property
    def folder(self) -> RunFolder:
        return RunFolder(self.spark)

    def stage(self, df: DataFrame) -> DataFrame:
        """Cut the lineage of a frame read by several consumers."""
        if self.materialize == "table":
            path = self.folder.next_path()
            df.write.parquet(path)
            return self.spark.read.parquet(path)
        if self.materialize == "persist":
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        if self.materialize == "checkpoint":
            checkpoint_dir(self.spark)
            return df.checkpoint(eager=True)
        return df

    def close(self) -> None:
        if "folder" in self.__dict__:
            self.folder.close()

    def __enter__(self) -> "BridgePlan":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    # ---- base layer ----------------------------------------------------------
    @cached_property
    def months(self) -> DataFrame:
        return month_driver(self.spark, self.policy.months)

    @cached_property
    def directory(self) -> DataFrame:
        return base.entity_directory(self.L)

    @cached_property
    def base(self) -> DataFrame:
        """B02 with schedule columns (discounts, schedule grain, B11)."""
        return base.ledger_base(self.L, self.policy)

    @cached_property
    def live(self) -> DataFrame:
        """Live cycles without the schedule join: pruned parquet scans for
        classification, swaps, penalty and add-on revenue."""
        return base.ledger_base(self.L, self.policy, with_schedule=False)

    @cached_property
    def split(self) -> dict[str, DataFrame]:
        return base.ledger_split(self.live)

    def _starting(self, df: DataFrame, start: dt.date, stop: dt.date | None = None) -> DataFrame:
        """Cycles starting from `start` on, before `stop`: literals on the raw
        column, so that the scan prunes by month."""
        return df.filter(F.col("rr_start_date") >= F.lit(start) if stop is None else within("rr_start_date", start, stop))

    @cached_property
    def opening_cycles(self) -> DataFrame:
        """B06 of the cycles that any month's opening or MTP rule can tag: all of
        them start in the month before the first one or later, and they start by the last
        one, were recognised about the months (a day wider, for IST) or belong to an entity
        that was bought in the months.  The rest goes before anything is dealt."""
        p, day = self.policy, dt.timedelta(days=1)
        bought = self.stage(self.buyouts.filter(within("tto_date", p.first_start, p.last_next)).select(*base.ENTITY_KEYS).distinct())
        near = (F.col("rr_start_date") < F.lit(p.last_next)) | within("recognised_at", p.first_prev_start - day, p.last_next + day)
        later = base.ledger_split(self._starting(self.live, p.first_prev_start))["entity"].join(bought.withColumn("_bought", F.lit(True)), base.ENTITY_KEYS, "left")
        cycles = base.revenue_cycles(self.L, p, later.filter(near | F.col("_bought")))
        return base.effective_recognition_date(cycles, self.buyouts)

    @cached_property
    def penalty_cycles(self) -> DataFrame:
        day = dt.timedelta(days=1)  # recognition is bucketed by IST date
        return self.split["penalty"].filter(within("recognised_at", self.policy.first_start - day, self.policy.last_next + day))

    @cached_property
    def vas_cycles(self) -> DataFrame:
        return self._starting(self.split["vas"], self.policy.first_prev_start, self.policy.last_next)

    @cached_property
    def scheduled(self) -> DataFrame:
        return base.ledger_split(self.base)["entity"]

    @cached_property
    def cycles(self) -> DataFrame:
        return base.revenue_cycles(self.L, self.policy, self.live)

    @cached_property
    def buyouts(self) -> DataFrame:
        return base.buyout_dates(self.L)

    @cached_property
    def effective(self) -> DataFrame:
        return base.effective_recognition_date(self.cycles, self.buyouts)

    @cached_property
    def grain(self) -> DataFrame:
        return base.schedule_grain(self.scheduled)

    # ---- components ----------------------------------------------------------
    @cached_property
    def classified(self) -> DataFrame:
        return self.stage(classify.classify_cycles(self.opening_cycles, self.months, self.policy))

    @cached_property
    def mtp(self) -> DataFrame:
        return classify.mtp_entities(self.classified)

    @cached_property
    def churn(self) -> dict[str, DataFrame]:
        return churn.churn_pipeline(self.L, self.policy, self.stage, None if self.materialize == "none" else self.stage)

    @cached_property
    def churn_table(self) -> DataFrame:
        if self.churn_source is not None:
            return self.churn_source.read(self.spark, refreshed_at=self.policy.as_of)
        return self.churn["table"]

    @cached_property
    def month_tagged(self) -> DataFrame:
        """C06 of the items churned in the months: what the bridge reads of churn."""
        if self.materialize == "none":  # the short lists cannot be cut off
            return self.churn["tagged"]
        return self.stage(churn.tagged_of_months(self.L, self.policy, self.churn["transactions"], self.stage, self.stage))

    @cached_property
    def churn_events(self) -> DataFrame:
        """R0C: from the published churn table if the plan has one, else from the
        churned rows of the months."""
        if self.churn_source is not None:
            return movements.churn_events(self.churn_table, self.mtp, self.months, self.policy)
        return movements.month_churn_events(self.L, self.month_tagged, self.mtp, self.months, self.policy, self.stage)

    @cached_property
    def swap_matches(self) -> DataFrame:
        if self.policy.swap_rank == "entity":  # a swap of another month may be the one that counts
            return swaps.swap_matches(swaps.one_swap_per_action(swaps.swap_events(self.L)), self.split["entity"])
        # staged: the planner knows how few they are, and deals no cycles for them
        return swaps.swap_matches(self.stage(swaps.swap_events(self.L, self.policy)), self.split["entity"])

    @cached_property
    def typed_discounts(self) -> DataFrame:
        return discounts.discount_types(discounts.discount_lines(self.scheduled), self.L)

    @cached_property
    def cycle_discounts(self) -> DataFrame:
        """One narrow row per cycle that R16, R20-R23 and D05 count or compare with."""
        return self.stage(discounts.recent_cycle_discounts(self.L, self.policy, self.split["entity"], self.stage))

    @cached_property
    def discount_per_cycle(self) -> DataFrame:
        return discounts.discount_per_cycle(self.cycle_discounts, self.policy)

    @cached_property
    def tenure_windowed(self) -> DataFrame:
        stage = None if self.materialize == "none" else self.stage
        return transitions.tenure_windowed(base.recent_grain(self.L, self.policy, self.split["entity"], stage))

    @cached_property
    def vas_owners(self) -> DataFrame:
        return vas.vas_owners(self.L, self.directory)

    @cached_property
    def vas_timing(self) -> DataFrame:
        return vas.vas_timing_detail(self.vas_cycles, self.vas_owners, self.months, self.policy)

    def _families(self) -> list[tuple[tuple[str, ...], object]]:
        """Components computed by one frame, and that frame (built only if asked for)."""
        p, d, m = self.policy, self.directory, self.months
        return [
            (("R01",), lambda: classify.opening_rows(self.classified)),
            (("R02",), lambda: classify.mtp_adjustment_rows(self.classified)),
            (("R14",), lambda: classify.current_mtp_rows(self.classified)),
            (("R04", "R05"), lambda: movements.acquisition_rows(self.L, m, p)),
            (tuple(movements.CHURN_RULES), lambda: movements.churn_component_rows(self.churn_events)),
            (("R12", "R13"), lambda: swaps.swap_rows(self.swap_matches, d, m)),
            (("R15",), lambda: movements.penalty_rows(self.penalty_cycles, self.L, m)),
            (("R16",), lambda: discounts.plan_transition_rows(self.cycle_discounts, d, m, p)),
            (("R18", "R19"), lambda: transitions.renewal_overdue_rows(self.tenure_windowed, d, m)),
            (("R20",), lambda: discounts.discount_given_rows(self.discount_per_cycle, d, m)),
            (("R21", "R22", "R23"), lambda: discounts.discount_change_rows(self.discount_per_cycle, d, m, p)),
            (("R24", "R25", "R26", "R27"), lambda: vas.vas_revenue_rows(self.vas_cycles, self.vas_owners, m, p)),
            (("R16P", "R17"), lambda: transitions.plan_transition_price_rows(self.tenure_windowed, d, m)),
        ]

    def family(self, component: str) -> DataFrame:
        """Entity-level rows of the frame that computes a component."""
        for members, build in self._families():
            if component in members:
                return build()
        raise KeyError(component)

    def families(self, components) -> DataFrame:
        """Entity-level rows of every frame that computes one of the components, each once."""
        wanted = set(components)
        frames = [build() for members, build in self._families() if wanted & set(members)]
        return reduce(DataFrame.unionByName, frames)

    def rows(self, component: str) -> DataFrame:
        """Entity-level rows of one component (long schema); nothing else is computed."""
        return self.family(component).filter(F.col("component") == component)

    @cached_property
    def bridge_rows(self) -> DataFrame:
        """Every component of the report, entity level (Q01 drill-down)."""
        out = None
        for members, build in self._families():
            if members == ("R16P", "R17"):
                continue
            rows = build().filter(~F.col("component").isin("R22", "R23"))
            out = rows if out is None else out.unionByName(rows)
        return out

    @cached_property
    def aggregated(self) -> DataFrame:
        # months x components rows, read ~8 times by the report: cut here
        return self.stage(assemble.aggregate_components(self.bridge_rows, self.policy.labels))

    def report(self) -> DataFrame:
        """The ordered revenue bridge."""
        v = vas.vas_bridge(self.vas_timing) if self.policy.vas_in_opening else None
        return assemble.revenue_bridge(self.aggregated, len(self.policy.months), v, self.policy.labels)
