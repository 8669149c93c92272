"""Shared pieces of the corpus operators: text expressions, row keys, staged
tables and distributed running sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def n_words(text: Column) -> Column:
    """Number of white-space separated words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (the same in every engine and locale)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def normal_line(line: Column) -> Column:
    """A line with A-Z lower-cased, white-space runs made one space, and trimmed."""
    return F.trim(F.regexp_replace(ascii_lower(line), r"[\x20\x09-\x0D]+", " "))


def uniform60(*parts: Column) -> Column:
    """A number from 0 to 2^60-1 from MD5 of the parts joined by ':' (null: '~')."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def as_row(df: DataFrame, *drop: str, **more: Column) -> DataFrame:
    """The columns of `df` but `drop` as one struct `row`, beside the columns `more`: whatever
    a caller's columns are called, they meet no name used inside an operator."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in drop]
    return df.select(F.struct(*keep).alias("row"), *[c.alias(n) for n, c in more.items()])


def row_key(*cols: Column) -> list[Column]:
    """Two 64-bit digests of a row's content, as columns `k1` and `k2`.

    Rows that agree in all of `cols` share a key, so any per-row result that is
    a function of these columns can be joined back by it; unlike an id column it
    needs neither uniqueness nor non-null ids, and unlike a generated row number
    it is the same on every recomputation.
    """
    marked = []
    for c in cols:
        marked += [c.isNull(), c]
    return [F.xxhash64(*marked).alias("k1"), F.xxhash64(F.lit(1), *marked).alias("k2")]


def group_key(col: Column) -> Column:
    """A non-null string key: 's' + value, or '' for null."""
    return F.coalesce(F.concat(F.lit("s"), col.cast("string")), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a scratch one only in local mode where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path


class Scratch:
    """Staged tables of one operator call, in the shared folder.

    `stage` writes a frame as Parquet and reads it back: lineage is cut by files
    that survive lost executors.  `drop` removes one that is no longer read;
    `close` removes the rest, once the result has been written; else they go with the driver.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.count = 0

    def stage(self, df: DataFrame) -> DataFrame:
        return self.read(self.write(df))

    def write(self, df: DataFrame) -> str:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        if self.count == 1:  # what nobody closes goes when the driver ends
            target, fs = self._file(self.root)
            fs.deleteOnExit(target)
        return path

    def read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def _file(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, path: str) -> None:
        target, fs = self._file(path)
        fs.delete(target, True)

    def close(self) -> None:
        self.drop(self.root)


def prefix_sums(df: DataFrame, group: str, u: str, weight: str, out: str, ties: list[Column] = (), bits: int = 12) -> DataFrame:
    """Add `out`: the sum of `weight` over the rows of the same `group` that come
    before this one in the order of `u` (0 to 2^60-1, uniform), then `ties`.

    A group may hold most rows, so it is never sorted as a whole: the top `bits`
    of `u` cut it into 2^bits parts whose sums (at most 2^bits rows a group) give
    each part's offset, and only the inside of a part is sorted by one task.
    `group` must not be null.
    """
    part = F.shiftrightunsigned(F.col(u), 60 - bits).cast("int")
    df = df.withColumn("_part", part)
    sums = df.groupBy(group, "_part").agg(F.sum(weight).alias("_sum"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(group, "_part").orderBy(u, *ties).rowsBetween(W.unboundedPreceding, -1)
    return (
        df.join(offsets, [group, "_part"])
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_part", "_offset")
    )


def global_index(df: DataFrame, order: str, out: str, scratch: Scratch) -> DataFrame:
    """Add `out`: each row's 0-based place in the order of the column `order` (nulls
    last).  Rows are range-partitioned and numbered inside their partition; only
    one count per partition is summed in one place."""
    rows = df.withColumn("_null", F.col(order).isNull())
    pid = F.spark_partition_id()
    parts = scratch.stage(rows.repartitionByRange("_null", order).withColumn("_pid", pid))
    sizes = parts.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_pid").orderBy("_null", order)
    return (
        parts.join(offsets, "_pid")
        .withColumn(out, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_null", "_pid", "_offset")
    )
