"""Exclusion by a list of keys with the rules of SQL's NOT IN for NULLs.

`(a, b) NOT IN (SELECT x, y ...)` keeps a row only if it differs for certain from
every row of the list: a NULL on either side might be equal, so it excludes unless
another column differs.  Spark runs such a tuple test as a nested loop.  Here the
list is split by which of its columns are NULL; for each such pattern only the
columns that both sides have can tell them apart, so every pattern is one anti join
with equalities on those columns (and on the pattern of the row).  An anti join with
`left_anti` alone is NOT EXISTS: NULLs never match there.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pattern(names: list[str]) -> F.Column:
    """Which key columns are there, as a bit mask."""
    return reduce(lambda a, b: a + b, [F.when(F.col(n).isNotNull(), 1 << i).otherwise(0) for i, n in enumerate(names)])


def not_in(rows: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose `keys` are NOT IN `listed` (same column names), as SQL has it.

    An empty list keeps all rows, those with NULLs too.  A listed row of NULLs only
    leaves no row; a row of NULLs only is kept by an empty list alone.  Repeated rows
    stay; the list may repeat too.
    """
    mine = [f"_mine_{i}" for i in range(len(keys))]
    out = rows.withColumn("_has", _pattern(keys))
    every = listed.select(*keys).distinct().withColumn("_has_listed", _pattern(keys))
    for there in product([False, True], repeat=len(keys)):
        mask = sum(1 << i for i, t in enumerate(there) if t)
        part = every.filter(F.col("_has_listed") == mask)
        # one row per pattern that the other side may have: only columns that both have are compared
        patterns = F.explode(F.array(*[F.lit(p) for p in range(1 << len(keys))])).alias("_has")
        part = part.select(*keys, patterns)
        shared = [(F.col("_has").bitwiseAND(F.lit(mask & (1 << i)))) != 0 for i in range(len(keys))]
        part = part.select("_has", *[F.when(s, F.col(k)).alias(m) for s, k, m in zip(shared, keys, mine)]).distinct()
        cut = out.withColumns({m: F.when(s, F.col(k)) for s, k, m in zip(shared, keys, mine)})
        same = [F.col(f"l.{m}").eqNullSafe(F.col(f"r.{m}")) for m in mine]
        out = cut.alias("l").join(part.alias("r"), reduce(lambda a, b: a & b, same, F.col("l._has") == F.col("r._has")), "left_anti").drop(*mine)
    return out.drop("_has")
