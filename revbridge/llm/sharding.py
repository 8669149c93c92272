"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size (a start and a step, so that the order visits every slot once); the shards
take turns claiming their most preferred free slot until the table is full.
Each then owns as many slots as any other, give or take one, and a changed set
of shards moves few slots.  A row's key hashes to a slot, and the slot's owner
is looked up in the broadcast table: constant time, no shuffle of the data.

The table depends on the shard names alone; its size is a parameter.
DataFrame functions only on the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revbridge.llm.common import as_row, uniform60

#: The table is broadcast; no larger one is built.
MAX_SLOTS = 1 << 20


def _hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def prime_from(n: int) -> int:
    """The smallest prime that is n or more."""
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def fill_table(names: list[str], slots: int) -> list[int]:
    """The owner (index in `names`) of every slot, by taking turns."""
    if not names or len(set(names)) < len(names):
        raise ValueError("shards must be named, each once")
    if prime_from(slots) != slots or not len(names) <= slots <= MAX_SLOTS:
        raise ValueError("slots must be a prime from the number of shards to MAX_SLOTS")
    at = [_hash60(f"start:{x}") % slots for x in names]
    step = [_hash60(f"step:{x}") % (slots - 1) + 1 for x in names]
    table, free = [-1] * slots, slots
    while True:
        for shard in range(len(names)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                return table


def table_frame(spark: SparkSession, names: list[str], slots: int) -> DataFrame:
    """The table as rows (`slot` long, `shard` string)."""
    table = fill_table(names, slots)
    return spark.createDataFrame([(i, names[s]) for i, s in enumerate(table)], "slot long, shard string")


def assign(df: DataFrame, key: list[Column], names: list[str], slots: int | None = None,
           spread_by: list[Column] = (), hot_share: float | None = None) -> DataFrame:
    """Add `slot` (long) and `shard` (string) to every row; nothing is dropped.

    A row's slot is the hash of its key columns modulo the table's size (by default
    the smallest prime of 100 slots a shard or more, which keeps shards within one
    per cent of each other).  Equal keys share a shard, repeated rows too; a null
    counts as a value of its own.  Columns named slot or shard are replaced.

    With `spread_by`, keys that hold more than `hot_share` of all rows (by default
    1 / shards; fewer such keys exist than 1 / hot_share, so joining them is
    bounded) are split: their rows are placed by key and `spread_by` together.
    """
    slots = slots or prime_from(100 * len(names))
    rows = as_row(df, "slot", "shard", place=uniform60(*key), spread=uniform60(*key, *spread_by))
    place = F.col("place")
    if spread_by:
        counts = rows.groupBy("place").agg(F.count("*").alias("n"))
        most = (hot_share or 1 / len(names)) * rows.count()
        hot = counts.filter(F.col("n") > F.lit(most)).select("place", F.lit(True).alias("hot"))
        rows = rows.join(F.broadcast(hot), "place", "left")
        place = F.when(F.col("hot"), F.col("spread")).otherwise(place)
    placed = rows.select("row", (place % slots).alias("slot"))
    table = table_frame(df.sparkSession, names, slots)
    return placed.join(F.broadcast(table), "slot").select("row.*", "slot", "shard")


def write_shards(df: DataFrame, path: str) -> None:
    """Write assigned rows as one folder per shard; rows of a shard are dealt to
    several tasks by slot, so that no task writes a whole shard."""
    df.repartition("shard", "slot").write.partitionBy("shard").parquet(path)
