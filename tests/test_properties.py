"""Invariants of the bridge on the bound sf0.001 ledger."""
from pyspark.sql import functions as F

from revbridge.operators import assemble
from revbridge.plans.bridge import BridgePlan
from revbridge.sources.tpch_binding import fixture_policy, ledger_for

SF = "/root/testdata/sf0.001"


def _counts(df):
    return {(r.month_num, r.tag): r["n"] for r in df.groupBy("month_num", "tag").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_tag_counts_match_independent_scratch_counts(spark):
    # S1.1 / S1.2 / current MTP (raw date) rows per month, counted independently in FIXTURES.md
    raw = BridgePlan(spark, ledger_for(spark, SF), fixture_policy(current_mtp_date="raw"))
    c = _counts(raw.classified)
    assert (c[(1, "S1.1")], c[(2, "S1.1")]) == (22, 29)
    assert (c[(1, "S1.2")], c[(2, "S1.2")]) == (16, 9)
    assert (c[(1, "CMTP")], c[(2, "CMTP")]) == (9, 11)


def test_mtp_carry_over_under_raw_dates(spark):
    # a cycle recognised early in month m (current MTP) is the MTP adjustment of month m+1
    raw = BridgePlan(spark, ledger_for(spark, SF), fixture_policy(current_mtp_date="raw"))
    c = _counts(raw.classified)
    assert c[(1, "CMTP")] == c[(2, "S1.2")]


def test_total_equals_partial_plus_full(spark):
    agg = assemble.all_components(BridgePlan(spark, ledger_for(spark, SF), fixture_policy()).aggregated)
    rows = {(r.month_num, r.component): (r.items_count, float(r.taxable_revenue)) for r in agg.collect()}
    for m in (1, 2):
        for total, part, full in (("R06", "R07", "R08"), ("R09", "R10", "R11")):
            if (m, total) in rows:
                assert rows[(m, total)][0] == rows[(m, part)][0] + rows[(m, full)][0]
                assert abs(rows[(m, total)][1] - rows[(m, part)][1] - rows[(m, full)][1]) < 1e-6


def test_report_independent_of_shuffle_partitions(spark):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plan = BridgePlan(spark, ledger_for(spark, SF), fixture_policy())
            results.append(sorted(tuple(r) for r in plan.report().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
