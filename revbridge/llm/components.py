"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch

_EDGE = "a long, b long"


def _hang_on_min(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Link each vertex' neighbours to its smallest neighbour (itself included).

    only_larger False (small star): the vertex and its smaller neighbours;
    True (large star): its larger neighbours.  The minimum is a map-side combined
    aggregate joined back, so a vertex with many neighbours is no group of its own.
    """
    if only_larger:
        sides = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        lows = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return sides.filter("b > a").join(lows, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lows = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(lows, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").unionByName(lows.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(`a`, `b`) edges of long vertices -> (`vertex`, `component`): for every vertex
    that has an edge to another, the smallest vertex it is connected to.

    Alternating large-star and small-star rounds, O(log^2 n) of them; each round
    is staged in the shared folder and the one before it removed.  It ends when a
    round leaves the edges as they were.
    """
    path = scratch.write(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(max_rounds):
        now = scratch.read(path)
        s = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(s) == mark or not s[0]:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        mark = tuple(s)
        after = scratch.write(_hang_on_min(_hang_on_min(now, True).distinct(), False).distinct())
        scratch.drop(path)
        path = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
