"""Skew-safe interval stabbing counts.

"How many of this user's items were active at time t?" is the question behind
the churn product's FULL/PARTIAL flags.  The reference answers it with a
self-join on the user (all pairs of a user's items), which is quadratic in the
size of the largest user.  Here it is a prefix sum of +1/-1 events:

    count(key, t) = sum(delta of events of `key` strictly before t)
                    (or at/before t for events marked inclusive)

computed in levels so no single task ever holds a whole key:

1. events of the same (key, instant) are summed first (map-side combined), and
   each instant is asked for once, however many rows ask,
2. per (key, day) totals by the same kind of aggregate,
3. a running sum over the *day totals* of each key (one row per active day),
4. a running sum inside each (key, day) over its distinct instants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_events(intervals: DataFrame, keys: list[str], start: str, end: str, closed: bool) -> DataFrame:
    """Events of intervals that hold an instant t when start < t and t <= end
    (`closed`) or t < end.  A NULL end never ends; empty intervals hold nothing."""
    holds = F.col(end).isNull() | (F.col(end) > F.col(start))
    valid = intervals.filter(holds)
    opens = valid.select(*keys, F.col(start).alias("time"), F.lit(1).alias("delta"), F.lit(False).alias("inclusive"))
    ends = valid.filter(F.col(end).isNotNull())
    closes = ends.select(*keys, F.col(end).alias("time"), F.lit(-1).alias("delta"), F.lit(not closed).alias("inclusive"))
    return opens.unionByName(closes)


def running(events: DataFrame, instants: DataFrame, keys: list[str], deltas: list[str], bucket: str = "day") -> DataFrame:
    """`instants` (distinct `keys`, `time`, none NULL) with, per column of `deltas`, its sum
    over the key's events before the instant (at it too for `inclusive` ones).

    events: `keys`, `time`, `inclusive`, `deltas`."""
    # at one instant: inclusive events (0), the query (1), the other events (2)
    order = F.when(F.col("inclusive"), F.lit(0)).otherwise(F.lit(2))
    ev = events.groupBy(*keys, "time", order.alias("_order")).agg(*[F.sum(d).alias(d) for d in deltas])
    q = instants.select(*keys, "time", F.lit(1).alias("_order"), *[F.lit(0).cast("long").alias(d) for d in deltas])
    both = ev.unionByName(q).withColumn("_bucket", F.date_trunc(bucket, F.col("time")))

    totals = both.groupBy(*keys, "_bucket").agg(*[F.sum(d).alias(d) for d in deltas])
    w_keys = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_bucket", *[F.coalesce(F.sum(d).over(w_keys), F.lit(0)).alias(f"_before_{d}") for d in deltas])
    w_in = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("time", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = both.withColumns({d: F.sum(d).over(w_in) for d in deltas}).filter(F.col("_order") == 1)
    return inside.join(totals, [*keys, "_bucket"]).select(*keys, "time", *[(F.col(f"_before_{d}") + F.col(d)).alias(d) for d in deltas])


def stab_counts(
    events: DataFrame,
    queries: DataFrame,
    keys: list[str],
    out: str = "count",
    bucket: str = "day",
) -> DataFrame:
    """Return `queries` plus column `out`.

    events:  keys..., `time` (timestamp), `delta` (int), `inclusive` (bool):
             an inclusive event counts for queries at the same instant.
    queries: keys..., `time` and any payload columns (kept as is).
    Rows whose key has a NULL never match (equi-join semantics).
    """
    not_null = F.col("time").isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    asked = queries.filter(not_null)
    answers = running(events.filter(not_null), asked.select(*keys, "time").distinct(), keys, ["delta"], bucket)
    return asked.join(answers.withColumnRenamed("delta", out), [*keys, "time"])


def covering_any(
    intervals: DataFrame, groups: DataFrame, key: str, group: list[str], start: str, end: str, closed: bool, out: str = "count",
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """For each group of instants, the number of the key's intervals that hold one
    of them or more (each interval once).

    intervals: `key`, `start`, `end` (one row per item; a NULL end never ends)
    groups:    `group` columns (they include `key`), `time`
    cut:       cuts the lineage of the sweep's result, which is read several times
               (default: a checkpoint)

    The instants of a group that an interval holds follow each other, so it is
    counted once by the instants that hold it less the pairs of consecutive
    instants that both do.

    The second count is over two orders: intervals that start before `a` and still
    hold the next instant `b`.  The first sweep ranks the intervals by their start;
    those that start before `a` are a prefix of the ranks, which is a few dyadic
    blocks, one per bit of its length.  Each interval is filed under the blocks that
    hold its rank, and the ends inside a block are swept like any other instants:
    n log n rows for the keys that ask, and no interval meets a group.
    """
    cut = cut or (lambda df: df.checkpoint())
    known = F.col(key).isNotNull()
    valid = intervals.filter(known & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start)))).select(
        key, F.col(start).alias("_start"), F.col(end).alias("_end")
    )
    at = groups.filter(F.col("time").isNotNull() & known).select(*group, "time").distinct()
    following = F.lead("time").over(Window.partitionBy(*group).orderBy("time"))
    steps = at.withColumn("_next", following).filter(F.col("_next").isNotNull())
    asking = valid.join(steps.select(key).distinct(), key, "left_semi")
    zero, one = F.lit(0), F.lit(1)
    events = valid.select(key, F.col("_start").alias("time"), F.lit(False).alias("inclusive"), one.alias("_begun"), zero.alias("_over")).unionByName(
        valid.filter(F.col("_end").isNotNull()).select(key, F.col("_end").alias("time"), F.lit(not closed).alias("inclusive"), zero.alias("_begun"), one.alias("_over"))
    )
    instants = at.select(key, "time").unionByName(asking.select(key, F.col("_start").alias("time"))).distinct()
    counts = cut(running(events, instants, [key], ["_begun", "_over"]))
    held = at.join(counts, [key, "time"]).groupBy(*group).agg(F.sum(F.col("_begun") - F.col("_over")).alias("_held"))

    prefix = steps.join(counts.select(key, "time", F.col("_begun").alias("_before")), [key, "time"])
    longest = prefix.groupBy(key).agg(F.max("_before").alias("_longest"))
    ends = asking.filter(F.col("_end").isNotNull())
    ranked = ends.join(counts.select(key, F.col("time").alias("_start"), F.col("_begun").alias("_rank")), [key, "_start"]).join(longest, key)
    # only blocks at even places are ever asked for
    own = F.expr("filter(sequence(0, length(bin(_longest)) - 1), l -> shiftright(_rank, l) % 2 = 0)")
    filed = ranked.filter("_rank < _longest").select(key, "_rank", F.col("_end").alias("time"), F.explode(own).alias("_level"))
    filed = filed.select(key, "_level", F.expr("shiftright(_rank, _level)").alias("_block"), "time", one.alias("delta"), F.lit(not closed).alias("inclusive"))
    bits = F.expr("filter(sequence(0, length(bin(_before)) - 1), l -> shiftright(_before, l) % 2 = 1)")
    asked = prefix.select(*group, "_before", F.col("_next").alias("time"), F.explode(bits).alias("_level"))
    asked = asked.withColumn("_block", F.expr("shiftright(_before, _level) - 1"))
    ended = stab_counts(filed, asked, [key, "_level", "_block"], out="_ended").groupBy(*group).agg(F.sum("_ended").alias("_ended"))
    twice = prefix.groupBy(*group).agg(F.sum("_before").alias("_before")).join(ended, group, "left")
    twice = twice.select(*group, (F.col("_before") - F.coalesce("_ended", zero)).alias("_twice"))
    return held.join(twice, group, "left").select(*group, (F.col("_held") - F.coalesce("_twice", zero)).alias(out))
