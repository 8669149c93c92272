"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]; prints ONE JSON line.

The bound ledger is loaded once (timed as `ledger_load`, like reading the
catalog tables); every headline query then runs on a fresh plan (no reuse of
another query's staged frames): 1 warm-up, median of $BENCH_REPS timed runs,
written to the `noop` sink so the whole result is computed.  $BENCH_MONTHS (2)
is the number of analysis months.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revbridge.operators import cycles, discounts  # noqa: E402
from revbridge.plans.bridge import BridgePlan  # noqa: E402
from revbridge.session import local_session  # noqa: E402
from revbridge.sources.tpch_binding import bind, fixture_policy  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    shared = tempfile.mkdtemp(prefix="revbridge-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), shared_dir=shared)
    months = tuple(dt.date(1997 + m // 12, m % 12 + 1, 1) for m in range(int(os.environ.get("BENCH_MONTHS", "2"))))
    policy = fixture_policy(months=months)

    t0 = time.time()
    ledger = bind(spark, sf_dir, policy)
    load = time.time() - t0

    def plan() -> BridgePlan:
        return BridgePlan(spark, ledger, policy, materialize=os.environ.get("BENCH_MATERIALIZE", "table"))

    def bridge():
        with plan() as p:
            run(p.report())

    def churn_table():
        with plan() as p:
            run(p.churn_table)

    def classification():
        with plan() as p:
            run(p.classified)

    def cycle_history():
        with plan() as p:
            pipe = cycles.labelling_pipeline(p.L, p.policy, p.months, p.churn["tagged"], stage=p.stage)
            run(cycles.cycle_history(pipe["L09"], p.policy))

    def plan_transition_detail():
        with plan() as p:
            run(discounts.plan_transition_detail(p.cycle_discounts, p.months, p.policy))

    headline = {
        "revenue_bridge": bridge,
        "churn_table": churn_table,
        "classification": classification,
        "cycle_history": cycle_history,
        "plan_transition_detail": plan_transition_detail,
    }
    results = {"ledger_load": round(load, 3)}
    for name, fn in headline.items():
        fn()  # warm-up
        times = []
        for _ in range(reps):
            t = time.time()
            fn()
            times.append(time.time() - t)
        results[name] = round(statistics.median(times), 3)
    total = round(sum(v for k, v in results.items() if k != "ledger_load"), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    ledger.close()
    spark.stop()


if __name__ == "__main__":
    main()
