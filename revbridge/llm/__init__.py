"""Operators for preparing large training corpora.

Each module holds one operator with its own general interface; `queries`
registers one query per operator (and the pipeline) over the given tables,
`oracle` holds the DuckDB SQL of those that SQL can express.  Nothing else in
the package imports this subpackage.
"""
