"""Mergeable distinct counts against sets, and swaps with cycles that tie."""
import datetime as dt
import random
from decimal import Decimal

from revbridge.operators import distinct, swaps

ROWS = "month_num int, component string, entity_type string, entity_id long, customer string"


def test_distinct_of_unions(spark):
    rnd = random.Random(4)
    rows = [(rnd.randint(1, 2), rnd.choice(["R01", "R04", "R08", "R11"]), rnd.choice(["ITEM", None]), rnd.choice([None, *range(40000, 40400)]), rnd.choice([None, "u1", *map(str, range(90))])) for _ in range(2000)]
    sets = distinct.distinct_sets(spark.createDataFrame(rows, ROWS).repartition(5), lambda df: df.checkpoint()).checkpoint()
    unions = {"one": {"ITEM": ["R01"], "CUSTOMER": ["R01"]}, "all": {"ITEM": ["R01", "R04", "R08"], "CUSTOMER": ["R08", "R11"]}, "none": {"ITEM": [], "CUSTOMER": ["R99"]}}
    got = {(r.month_num, r.kind): (r.one, r["all"], r.none) for r in distinct.distinct_of_unions(sets, unions).collect()}
    want = {}
    for m in (1, 2):
        items = lambda cs: len({(t, e) for n, c, t, e, _ in rows if n == m and c in cs and t and e is not None})
        customers = lambda cs: len({u for n, c, _, _, u in rows if n == m and c in cs and u})
        want[m, "ITEM"] = (items(["R01"]), items(["R01", "R04", "R08"]), 0)
        want[m, "CUSTOMER"] = (customers(["R01"]), customers(["R08", "R11"]), 0)
    assert got == want


def test_swap_peers_keep_ties(spark):
    day = lambda n: dt.date(2026, 1, n)
    cycles = [(1, "ITEM", dt.datetime(2026, 1, d), Decimal(a)) for d, a in ((1, 5), (10, 7), (10, 9), (10, 7), (20, 1))] + [(2, "ITEM", dt.datetime(2026, 1, 15), Decimal(3))]
    events = [(1, "ITEM", "SWAP_OUT", day(12)), (1, "ITEM", "SWAP_IN", day(10)), (1, "ITEM", "SWAP_IN", day(21)), (2, "ITEM", "SWAP_OUT", day(3)), (2, "ITEM", "SWAP_OUT", day(15))]
    out = swaps.swap_peers(
        spark.createDataFrame(events, "entity_id long, entity_type string, action string, fulfillment_date date"),
        spark.createDataFrame(cycles, "accountable_entity_id long, accountable_entity_type string, rr_start_date timestamp_ntz, taxable_amount decimal(18,2)"),
    )
    got = sorted((r.entity_id, r.action, r.fulfillment_date.day, r.place, r.peers, r.taxable_amount and int(r.taxable_amount)) for r in out.collect())
    assert got == [
        (1, "SWAP_IN", 10, 1, 3, 9), (1, "SWAP_IN", 10, 2, 3, 7), (1, "SWAP_IN", 10, 3, 3, 7), (1, "SWAP_IN", 21, 1, 0, None),
        (1, "SWAP_OUT", 12, 1, 3, 9), (1, "SWAP_OUT", 12, 2, 3, 7), (1, "SWAP_OUT", 12, 3, 3, 7),
        (2, "SWAP_OUT", 3, 1, 0, None), (2, "SWAP_OUT", 15, 1, 1, 3),
    ]
