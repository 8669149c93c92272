"""Run registered queries against their DuckDB oracle (like the driver does).

usage: python tests/oracle_check.py SF_DIR [key-substring ...]
"""
import math
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, ".")
import __spark_entry__ as E  # noqa: E402
from revbridge.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        if v.is_integer():
            return str(int(v))
        return repr(round(v, 6))
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    out = sorted(tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))
    return cols, out


def main():
    sf = sys.argv[1]
    pats = sys.argv[2:]
    spark = local_session(shared_dir=tempfile.mkdtemp(prefix="revbridge-check-"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if pats and not any(p in k for p in pats):
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{k}: SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in orc:
            print(f"{k}: rows={len(sp)} (no oracle) {ts:.1f}s")
            continue
        try:
            dd = con.sql(orc[k]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{k}: DUCKDB ERROR {str(e)[:400]}")
            bad += 1
            continue
        c1, r1 = rows(sp)
        c2, r2 = rows(dd)
        ok = c1 == c2 and r1 == r2
        msg = "OK" if ok else "MISMATCH"
        print(f"{k}: {msg} spark={len(r1)} duck={len(r2)} {ts:.1f}s")
        if not ok:
            bad += 1
            if c1 != c2:
                print("   cols spark", c1, "\n   cols duck ", c2)
            else:
                s1, s2 = set(r1), set(r2)
                print("   only spark:", sorted(s1 - s2)[:3])
                print("   only duck: ", sorted(s2 - s1)[:3])
    print("failures:", bad)


if __name__ == "__main__":
    main()
