"""Returns that end an attachment's cycle: its own and its parent items'."""
import datetime as dt

from revbridge.operators import cycles
from revbridge.policy import Policy
from revbridge.sources.ledger import Ledger

from test_worked_examples import cycle, item, ts

POLICY = Policy(months=(dt.date(2026, 1, 1),), as_of=dt.date(2026, 6, 1))


def ret(i, entity, day, state="COMPLETED"):
    return (i, entity, i, state, ts(day + " 06:00:00"), ts(day + " 08:00:00"))


def found(spark, **rows):
    L = Ledger.from_rows(spark, **rows)
    out = cycles.return_through_parent(cycles.labelling_cycles(L, POLICY), L).collect()
    return sorted((r.accountable_entity_type, r.accountable_entity_id, str(r.cycle_start_date), r.return_item_id, r.return_route, r.returned_directly, r.returned_with_parent) for r in out)


def test_both_routes_shared_composites_and_no_fan_out(spark):
    jan = dict(etype="ATTACHMENT")
    got = found(
        spark,
        items=[item(1, 7, composite=50), item(2, 7, composite=50), item(3, 7, composite=60, state="CANCELLED"), item(4, 7)],
        attachments=[item(11, 7, composite=50), item(12, 7, composite=50), item(13, 7, composite=60), (14, 7, 1, "ACTIVE", "RENTAL", None, None, None)],
        return_items=[ret(101, 1, "2026-01-10"), ret(102, 2, "2026-01-05"), ret(103, 2, "2026-01-04", "CANCELLED"), ret(104, 3, "2026-01-06"), ret(105, 4, "2026-01-07")],
        return_attachments=[ret(201, 11, "2026-01-03"), ret(202, 13, "2026-01-20"), ret(203, 14, "2025-11-01")],
        recognitions=[
            cycle(1, "2026-01-01", 10), cycle(11, "2026-01-01", 10, **jan), cycle(11, "2026-01-01", 10, **jan), cycle(11, "2026-02-15", 10, **jan),
            cycle(12, "2026-01-01", 10, **jan), cycle(13, "2026-01-01", 10, **jan), cycle(14, "2026-01-01", 10, **jan),
        ],
    )
    assert got == [
        ("ATTACHMENT", 11, "2026-01-01", 102, "PARENT", True, True),  # the parents' earliest, before its own; both equal cycles
        ("ATTACHMENT", 11, "2026-01-01", 102, "PARENT", True, True),
        ("ATTACHMENT", 11, "2026-02-15", None, None, False, False),
        ("ATTACHMENT", 12, "2026-01-01", 102, "PARENT", False, True),
        ("ATTACHMENT", 13, "2026-01-01", 202, "DIRECT", True, False),  # a cancelled item is no parent
        ("ATTACHMENT", 14, "2026-01-01", None, None, False, False),
        ("ITEM", 1, "2026-01-01", 101, "DIRECT", True, False),
    ]
