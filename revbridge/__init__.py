"""revbridge: a Spark-native revenue-bridge engine for rental ledgers.

Layout
------
sources/    ledger tables (catalog/parquet reader, the test binding, sinks)
functions/  column expressions shared by operators (IST dates, tenure, JSON)
operators/  one module per product: base, churn, classify, movements,
            transitions, vas, swaps, discounts, cycles, assemble
plans/      month drivers, the bridge plan, persistence cut points
checks/     independent DuckDB SQL used as the correctness oracle
"""

from revbridge.policy import Policy  # noqa: F401
