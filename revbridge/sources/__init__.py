"""Ledger sources: catalog / parquet tables and the test binding."""
