"""NOT IN with NULLs against its definition, and its plan."""
import itertools

import pytest

from revbridge.operators.exclusion import not_in

VALUES = [None, 1, 2]
SCHEMA = "a int, b int, n int"


def same(x, y):
    """SQL's tuple equality: False if any column differs for certain, else True or unknown (None)."""
    if any(p is not None and q is not None and p != q for p, q in zip(x, y)):
        return False
    return None if None in x or None in y else True


def kept(rows, listed):
    return sorted(((*r, n) for n, r in enumerate(rows) if all(same(r, k) is False for k in listed)), key=repr)


PAIRS = list(itertools.product(VALUES, VALUES)) * 2


@pytest.mark.parametrize("listed", [
    [], [(1, 2)], [(1, None)], [(None, 2)], [(None, None)], [(1, 2), (2, None), (1, 2)], [(1, 1), (None, 1)], [(3, 3)],
])
def test_against_the_definition(spark, listed):
    rows = spark.createDataFrame([(*r, n) for n, r in enumerate(PAIRS)], SCHEMA)
    got = not_in(rows, spark.createDataFrame(listed, "a int, b int"), ["a", "b"])
    assert got.columns == ["a", "b", "n"]
    assert sorted(map(tuple, got.collect()), key=repr) == kept(PAIRS, listed)


def test_one_key_and_no_rows(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert [r.a for r in not_in(rows, spark.createDataFrame([(1,)], "a int"), ["a"]).collect()] == [2]
    assert not_in(rows.limit(0), spark.createDataFrame([(1,)], "a int"), ["a"]).collect() == []


def test_only_equalities_are_joined(spark):
    rows = spark.createDataFrame([(1, 2, 3)], SCHEMA)
    plan = not_in(rows, spark.createDataFrame([(1, None)], "a int, b int"), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
