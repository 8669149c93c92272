"""Every corpus query that SQL can express, against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from revbridge.llm.oracle import oracle_sql
from revbridge.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, db, name):
    got = queries()[name](spark, SF)
    want = db.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in cols]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert rows == expected
