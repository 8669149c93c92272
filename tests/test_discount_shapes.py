"""Every odd discount list is named with its reason; good ones are not."""
import pytest

from revbridge.operators.discount_shapes import discount_faults, fault_summary

SCHEMA = "accountable_entity_id long, accountable_entity_type string, revenue_recognition_schedule_id long, rr_start_date timestamp_ntz, discounts string"
GOOD = '{"amount": 12.5, "catalogReferenceId": "7", "code": "A"}'


def faults(spark, *texts):
    rows = [(i, "ITEM", 1, None, t) for i, t in enumerate(texts)]
    return discount_faults(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("text,want", [
    (None, []), ("", []), ("  ", []), ("null", []), ("[]", []), (f"[{GOOD}, {GOOD}]", []), ('[{"amount": 3, "catalogReferenceId": 7}]', []),
    ("no discounts", [(None, "not JSON")]), (f"[{GOOD}", [(None, "not JSON")]),
    (GOOD, [(None, "object instead of a list")]), ("12", [(None, "neither list nor object")]), ('"text"', [(None, "neither list nor object")]),
    (f"[{GOOD}, 5, null]", [(1, "no object"), (2, "no object")]),
    ('[{"catalogReferenceId": "7"}]', [(0, "no amount")]), ('[{"amount": null, "catalogReferenceId": "7"}]', [(0, "no amount")]),
    ('[{"amount": "12", "catalogReferenceId": "7"}]', [(0, "amount is no number")]), ('[{"amount": -1, "catalogReferenceId": "7"}]', [(0, "amount below zero")]),
    (f'[{GOOD}, {{"amount": {{}}}}]', [(1, "amount is no number"), (1, "no catalog reference")]),
    ('[{"amount": 1, "catalogReferenceId": "7", "extra": 1}]', [(0, "other members")]),
    ('{"amount": "x"}', [(0, "amount is no number"), (0, "no catalog reference"), (None, "object instead of a list")]),
])
def test_reasons(spark, text, want):
    assert sorted(((r.line, r.reason) for r in faults(spark, text).collect()), key=str) == sorted(want, key=str)


def test_summary(spark):
    got = {r.reason: (r.n_rows, r.example) for r in fault_summary(faults(spark, "bad", "worse", GOOD, "[]")).collect()}
    assert got == {"not JSON": (2, "bad"), "object instead of a list": (1, GOOD)}
