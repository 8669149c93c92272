"""Merkle manifest of a dataset: a digest per row, a subroot per group, one root, and a
proof path per row that lets anyone recompute the root from that row alone.

A group's rows ascend by key.  While a group has more than one node, every `FANOUT`
consecutive ones (its last run: fewer, even one) become their parent.  The groups'
subroots, in the order of their names, are the leaves of the upper tree.

Per level, lag and lead columns of the fixed offsets 1 to FANOUT - 1, masked by a node's
slot and the length of its run, hold its siblings; the first child of every run hashes the
parent.  Windows are one run (at most FANOUT rows) wide, so a group that holds most rows
is spread over all tasks.  Places come from a range partitioning, whose counts by (group,
partition) give every partition's first place: no group is sorted by one task.  Levels are
staged tables; on the way back each node joins its parent's path, by (group, run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from revbridge.llm.common import Scratch, group_key

#: Consecutive nodes that become one.
FANOUT = 8
PATH = "array<struct<before:string,after:string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of the values in turn: '-' for null, else the number of UTF-8
    bytes, ':' and the value as text."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that `leaf` and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level to the root, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def place(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Stage `nodes` (`g`, `key`, `digest`, ...) with `pos`, the place in its group, and `n`,
    the group's size.  Keys ascend, null first; equal keys by digest.  Equal rows are told
    apart by `_salt`, a number fixed by the staged table, so that they too are spread."""
    by = ["g", "key", "digest", "_salt"]
    fixed = scratch.stage(nodes.withColumn("_salt", F.monotonically_increasing_id()))
    spread = fixed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    rows = scratch.stage(spread.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = rows.groupBy("g", "_part").agg(F.count("*").alias("_c"), F.min("_row").alias("_first"))
    before = W.partitionBy("g").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        "g", "_part", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_offset"), F.sum("_c").over(W.partitionBy("g")).alias("n")
    )
    return rows.join(counts, ["g", "_part"]).withColumn("pos", F.col("_offset") + F.col("_row")).drop("_at", "_part", "_row", "_offset")


def with_siblings(level: DataFrame) -> DataFrame:
    """Add `run`, `slot`, and the concatenated digests `before` and `after` a node in its run."""
    level = level.withColumn("run", F.floor(F.col("pos") / FANOUT)).withColumn("slot", (F.col("pos") % FANOUT).cast("int"))
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    run = W.partitionBy("g", "run").orderBy("slot")
    before = [F.when(F.col("slot") >= k, F.lag("digest", k).over(run)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(F.col("slot") + k < length, F.lead("digest", k).over(run)) for k in range(1, FANOUT)]
    return level.withColumns({"before": F.concat_ws("", *before), "after": F.concat_ws("", *after)})


def parents(level: DataFrame) -> DataFrame:
    first = level.filter("slot = 0")
    return first.select("g", F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), F.sha2(F.concat("digest", "after"), 256).alias("digest"))


def build(level: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], list[DataFrame]]:
    """(levels with siblings, top nodes met at each level): level k holds the nodes of the
    groups that still have several; top nodes are (`g`, `digest`, other columns)."""
    levels, tops = [], []
    largest = level.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        here = scratch.stage(with_siblings(level.filter("n > 1")))
        levels.append(here)
        tops.append(level.filter("n = 1"))
        level, largest = parents(here), -(-largest // FANOUT)
    return levels, [*tops, level.filter("n = 1")]


def paths(levels: list[DataFrame], tops: list[DataFrame], known: DataFrame, keep: list[str]) -> DataFrame:
    """The lowest nodes with `path`, the siblings up to the root, and the columns of `known`
    (`g`, `path` of the top node, others), which has one row a group."""
    more = [c for c in known.columns if c not in ("g", "path")]
    out = None
    for k in reversed(range(len(tops))):
        low = keep if k == 0 else []
        mine = tops[k].select("g", "pos", *low).join(known, "g").select("g", "pos", "path", *more, *low)
        if out is not None:
            up = out.select("g", F.col("pos").alias("run"), F.col("path").alias("_up"), *more)
            own = F.array(F.struct("before", "after"))
            step = levels[k].select("g", "pos", "run", "before", "after", *low).join(up, ["g", "run"])
            mine = mine.unionByName(step.select("g", "pos", F.concat(own, "_up").alias("path"), *more, *low))
        out = mine
    return out


def manifest(
    rows: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id", group: str = "lang", tampered: dict[str, Column] | None = None, scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of `rows`: `key` (the key column), `leaf`, `subroot`, `root`, `path`
    (see `fold` and `proof_text`) and `other_leaf`, the digest of the row with the columns
    of `tampered` in place of its own.

    Null keys come first in their group, null groups before all others; rows of one key by
    their digest.  Equal rows keep one leaf each.  A lone row's leaf is its group's subroot,
    a lone group's subroot the root.  An empty table has no rows and no root.
    """
    scratch = scratch or Scratch(rows.sparkSession)
    tampered = tampered or {}
    value = {f: F.col(f"`{f}`") for f in fields}
    leaves = rows.select(
        group_key(F.col(f"`{group}`")).alias("g"), F.col(f"`{key}`").alias("key"), digest_of(*value.values()).alias("digest"),
        digest_of(*[tampered.get(f, c) for f, c in value.items()]).alias("other_leaf"),
    )
    placed = place(leaves, scratch)
    levels, tops = build(placed, scratch)
    subroots = tops[0].select("g", "digest")
    for t in tops[1:]:
        subroots = subroots.unionByName(t.select("g", "digest"))
    groups = place(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), "digest"), scratch)
    upper_levels, upper_tops = build(groups, scratch)
    roots = upper_tops[-1].select("g", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.col("digest").alias("root"))
    known = paths(upper_levels, upper_tops, roots, ["key", "digest"])
    known = scratch.stage(known.select(F.col("key").alias("g"), "path", "root", F.col("digest").alias("subroot")))
    out = paths(levels, tops, known, ["key", "digest", "other_leaf"])
    return out.select("key", F.col("digest").alias("leaf"), "other_leaf", "subroot", "root", "path")
