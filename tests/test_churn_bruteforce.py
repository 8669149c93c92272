"""The skew-safe churn rewrites against brute force on random ledgers.

FULL/PARTIAL scope (C03) and remaining-item counts (C05) are computed by the
prefix-sum sweep in Spark; here they are recomputed with the plain pairwise
definition in Python.  The generator also produces the odd cases (transactions
before activation, same-instant events, items with both a return and a buy-out,
with several live returns or paid buy-outs, orders shared by items, dates apart
within one return).
"""
import datetime as dt
import random

import pytest

from revbridge.operators import churn
from revbridge.operators.sweep import covering_any, stab_counts
from revbridge.policy import Policy
from revbridge.sources.ledger import Ledger

BASE = dt.datetime(2025, 1, 1)


def rand_ledger(spark, seed, n_users=6, max_items=5):
    rnd = random.Random(seed)
    items, returns, rtp, rto = [], [], [], []
    iid = 1
    for u in range(1, n_users + 1):
        for _ in range(rnd.randint(1, max_items)):
            act = BASE + dt.timedelta(days=rnd.randint(0, 40), minutes=rnd.choice([0, 0, 330, 700]))
            kind = rnd.random()
            pickup = None
            if kind < 0.45:  # return, sometimes on a shared date, sometimes before activation
                for n in range(rnd.choice([1, 1, 2])):
                    created = act + dt.timedelta(days=rnd.choice([-3, 5, 10, 10, 20]) + 7 * n)
                    state = rnd.choice(["COMPLETED", "COMPLETED", "CANCELLED"])
                    returns.append((iid * 10 + n, iid, u * 10 + n, state, created, created + dt.timedelta(days=1)))
                    if state == "COMPLETED":
                        pickup = created + dt.timedelta(days=rnd.choice([0, 3]))
            if 0.35 < kind < 0.7:  # buy-out (some items get both)
                for n in range(rnd.choice([1, 1, 2])):
                    created = act + dt.timedelta(days=rnd.choice([-2, 7, 10, 15]) + 9 * n)
                    paid = rnd.random() < 0.8
                    order = 1000 + iid * 10 + n
                    rtp.append((iid * 10 + n, iid, order, '{"s":"PAID"}' if paid else '{"s":"DUE"}', '{"byCashPreTax":"10"}'))
                    rto.append((order, rnd.choice(["CONFIRMED", "CANCELLED"]), created))
            items.append((iid, u, iid, "ACTIVE", "RENTAL", act, pickup, iid, f"i{iid}", '{"basePrice":1}'))
            iid += 1
    return Ledger.from_rows(spark, items=items, return_items=returns, rtp_items=rtp, rtp_orders=rto)


def brute_scope(txn_rows):
    base = [r for r in txn_rows if r.transaction_id is not None]
    groups = {}
    for b in base:
        groups.setdefault((b.transaction_id, b.user_id, b.transaction_type), []).append(b)
    out = {}
    for g, bs in groups.items():
        held = set()
        for b in bs:
            for e in txn_rows:
                if (e.user_id == b.user_id and e.activation_date < b.item_transaction_date
                        and e.item_transaction_date is not None and e.item_transaction_date >= b.item_transaction_date):
                    held.add(e.item_id)
        out[g] = "FULL" if len({b.item_id for b in bs}) == len(held) else "PARTIAL"
    return out


def brute_remaining(rib_rows):
    out = {}
    for b1 in rib_rows:
        n = set()
        for b2 in rib_rows:
            if (b1.pickup_date is not None and b2.user_ids == b1.user_ids and b2.item_ids != b1.item_ids
                    and b2.activation_dates < b1.pickup_date
                    and (b2.pickup_date is None or b2.pickup_date > b1.pickup_date)):
                n.add(b2.item_ids)
        out[b1.item_ids] = len(n)
    return out


def brute_cross(txn_rows):
    out = {}
    for b in txn_rows:
        if b.transaction_id is not None:
            same = [e for e in txn_rows if e.user_id == b.user_id and e.activation_date < b.item_transaction_date]
            held = {e.item_id for e in same if e.item_transaction_date is not None and e.item_transaction_date >= b.item_transaction_date}
            out[b.item_id, b.transaction_id, b.transaction_type, b.item_transaction_date] = (len({e.item_id for e in same}), len(held))
    return out


def one_item_ledger(spark, returns=(), buyouts=(), others=()):
    """Item 1 of user 1, and `others` (id, activation, return and pickup), by days after BASE."""
    day = lambda d: BASE + dt.timedelta(days=d)
    items = [(1, 1, 1, "ACTIVE", "RENTAL", day(0), day(40) if returns else None, 1, "i1", '{"basePrice":1}')]
    items += [(i, 1, i, "ACTIVE", "RENTAL", day(a), day(p), i, f"i{i}", '{"basePrice":1}') for i, a, p in others]
    ret = [(100 + n, 1, 100 + n, "COMPLETED", day(d), day(d)) for n, d in enumerate(returns)]
    ret += [(150 + i, i, 150 + i, "COMPLETED", day(p), day(p)) for i, _, p in others]
    rtp = [(200 + n, 1, 300 + n, '{"s":"PAID"}', '{"byCashPreTax":"10"}') for n, _ in enumerate(buyouts)]
    rto = [(300 + n, state, day(d)) for n, (d, state) in enumerate(buyouts)]
    return Ledger.from_rows(spark, items=items, return_items=ret, rtp_items=rtp, rtp_orders=rto)


def churn_frames(L):
    return churn.churn_pipeline(L, Policy(months=(dt.date(2025, 1, 1),), as_of=dt.date(2025, 12, 31)), stage=lambda df: df.checkpoint())


def test_two_live_returns_of_one_item(spark):
    f = churn_frames(one_item_ledger(spark, returns=(9, 40)))
    scope = {r.transaction_id: r.full_or_partial_flag for r in f["scope"].collect()}
    assert scope == {100: "FULL", 101: "FULL"}
    cross = churn.user_item_cross(f["transactions"]).collect()
    assert [(r.earlier_items, r.still_held) for r in cross] == [(1, 1), (1, 1)]


def test_another_item_with_two_returns_counts_once(spark):
    f = churn_frames(one_item_ledger(spark, returns=(9, 45), others=[(2, 1, 20)]))
    counts = {r.item_ids: r.later_items_count for r in f["counts"].collect()}
    assert counts == {1: 0, 2: 1}


def test_two_paid_buyouts_do_not_multiply(spark):
    f = churn_frames(one_item_ledger(spark, buyouts=((10, "CONFIRMED"), (30, "CANCELLED"))))
    assert sorted((r.transaction_id, r.churn_flag) for r in f["tagged"].collect()) == [(300, "FULL"), (301, "FULL")]
    assert {r.item_ids: r.later_items_count for r in f["counts"].collect()} == {1: 0}


def test_scope_and_remaining_match_bruteforce(spark):
    policy = Policy(months=(dt.date(2025, 1, 1),), as_of=dt.date(2025, 12, 31))
    for seed in range(6):
        L = rand_ledger(spark, seed)
        txn = churn.item_transactions(L, policy).checkpoint()
        rows = txn.collect()
        got = {(r.transaction_id, r.user_id, r.transaction_type): r.full_or_partial_flag
               for r in churn.transaction_scope(txn).collect()}
        assert got == brute_scope(rows), seed
        cross = churn.user_item_cross(txn).collect()
        assert {
            (r.base_item_id, r.transaction_id, r.transaction_type, r.transaction_date): (r.earlier_items, r.still_held) for r in cross
        } == brute_cross(rows), seed
        assert len(cross) == len(brute_cross(rows))
        detail = churn.transaction_detail(L, txn, churn.transaction_scope(txn), policy)
        rib = churn.rental_item_base(L, policy, detail).checkpoint()
        counts = {r.item_ids: r.later_items_count for r in churn.remaining_item_count(rib).collect()}
        assert counts == brute_remaining(rib.collect()), seed


def test_stab_counts_bruteforce(spark):
    rnd = random.Random(7)
    ev, q = [], []
    for _ in range(300):
        k = rnd.randint(1, 4)
        t = BASE + dt.timedelta(hours=rnd.randint(0, 24 * 6))
        ev.append((k, t, rnd.choice([1, -1, 2]), rnd.random() < 0.5))
    for i in range(80):
        q.append((rnd.randint(1, 4), BASE + dt.timedelta(hours=rnd.randint(0, 24 * 6)), i))
    events = spark.createDataFrame(ev, "k long, time timestamp_ntz, delta int, inclusive boolean")
    queries = spark.createDataFrame(q, "k long, time timestamp_ntz, qid int")
    got = {r.qid: r["count"] for r in stab_counts(events, queries, ["k"]).collect()}
    for k, t, qid in q:
        want = sum(d for kk, tt, d, inc in ev if kk == k and (tt < t or (inc and tt == t)))
        assert got[qid] == want


@pytest.mark.parametrize("closed", [True, False])
def test_intervals_that_hold_any_instant_of_a_group(spark, closed):
    """One user holds nearly all intervals and asks with many groups of several instants."""
    rnd = random.Random(11)
    hour = lambda a, b: BASE + dt.timedelta(hours=rnd.randint(a, b))
    users = [1] * 120 + [2] * 9 + [3, None]
    held = [(u, hour(0, 300), rnd.choice([None, hour(0, 400), hour(200, 500)])) for u in users] + [(1, None, hour(0, 9))]
    asked = [(g, rnd.choice([1, 1, 1, 2, 3, 4]), rnd.choice([1, 2, 2, 3, 6])) for g in range(90)]
    groups = [(g, u, hour(0, 450)) for g, u, n in asked for _ in range(n)] + [(200, None, hour(0, 400)), (201, 1, None)]
    intervals = spark.createDataFrame(held, "u long, a timestamp_ntz, b timestamp_ntz").checkpoint()
    instants = spark.createDataFrame(groups, "g long, u long, time timestamp_ntz").checkpoint()
    got = {(r.g, r.u): r.n for r in covering_any(intervals, instants, "u", ["g", "u"], "a", "b", closed, out="n").collect()}
    want = {}
    for g, u, t in groups:
        if u is not None and t is not None:
            want.setdefault((g, u), set())
            for i, (v, a, b) in enumerate(held):
                if v == u and a is not None and a < t and (b is None or t < b or (closed and t == b)):
                    want[g, u].add(i)
    assert got == {k: len(v) for k, v in want.items()}
