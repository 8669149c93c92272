"""Every registered query against its independent DuckDB SQL (sf0.001)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from revbridge.checks.oracle_queries import oracle_sql
from revbridge.plans.registry import queries

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(str(_norm(r[c])) for c in cols) for r in pdf.to_dict("records")))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sp = queries()[key](spark, SF).toPandas()
    dd = con.sql(oracle_sql()[key]).df()
    assert _rows(sp) == _rows(dd)


def test_every_query_has_rows_or_oracle(spark):
    assert set(queries()) == set(oracle_sql())
    assert set(oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 26 and "component" in df.columns
