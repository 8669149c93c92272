"""Removing boilerplate lines that many distinct sites share.

Lines are hashed; a HyperLogLog sketch per line hash counts its distinct sites.
Sketches merge by aggregation: they are built on the map side, so a line that a
third of all documents carry sends one small sketch per task.  Lines whose
estimate is well above the threshold are boilerplate, those well below are not;
the few in between, where the sketch could be wrong, get an exact distinct count.
Boilerplate lines leave every document.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import Scratch, as_row, normal_line, row_key

#: 2^LG_K registers; an estimate's standard error is 1.04 / 2^(LG_K / 2).
LG_K = 12
#: Standard errors within which an estimate is not trusted, and lines at least.
MARGIN_ERRORS = 8
MARGIN_SITES = 2
#: Parts in which the rows of a (line, site) are thinned out for the exact count.
SALTS = 64


def near_threshold(min_sites: int) -> tuple[int, int]:
    """Estimates from `low` to `high` are counted exactly."""
    off = MARGIN_ERRORS * 1.04 / math.sqrt(1 << LG_K)
    return math.floor(min_sites * (1 - off)) - MARGIN_SITES, math.ceil(min_sites * (1 + off)) + MARGIN_SITES


def line_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per line that is not blank: `keep`, `at` (from 0), `h1`, `h2`.
    The two hashes of the normalised line are its identity (128 bits)."""
    lines = docs.select(*keep, F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.select(*keep, "at", normal_line(F.col("line")).alias("line")).filter("line != ''")
    return lines.select(*keep, "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int, site: str = "site") -> DataFrame:
    """(`h1`, `h2`) of the lines that `min_sites` distinct sites or more carry (null is no site)."""
    low, high = near_threshold(min_sites)
    sketch = F.hll_sketch_agg(site, F.lit(LG_K)).alias("sketch")
    seen = lines.groupBy("h1", "h2").agg(F.min(site).alias("a"), F.max(site).alias("b"), sketch).filter("a is not null")
    if min_sites <= 1:
        return seen.select("h1", "h2")
    counted = seen.filter("a < b").select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") >= low)
    sure = counted.filter(F.col("sites") > high).select("h1", "h2")
    near = counted.filter(F.col("sites") <= high).select("h1", "h2")
    held = lines.filter(F.col(site).isNotNull()).select("h1", "h2", site, "k1").join(near, ["h1", "h2"], "left_semi")
    # dealt by row as well, so that a line that many documents of a site carry is thinned out before it meets
    pairs = held.repartition("h1", "h2", site, F.pmod("k1", F.lit(SALTS))).groupBy("h1", "h2", site).agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites).select("h1", "h2")
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, site: str = "source") -> DataFrame:
    """Take the lines that `min_sites` or more sites carry out of every document.

    Returns all rows and columns of `docs` with `text` rewritten (the other lines,
    unchanged, joined by newline), and `n_lines` (blank ones included) and
    `n_removed` added (columns of these names are replaced).  Lines are compared
    with A-Z lower-cased and white space squeezed; blank lines always stay.  A null
    text stays null, with 0 lines; an empty one has one blank line.  A null site
    counts for no line, but its documents are cleaned as well.  A document of
    boilerplate alone keeps its row, with what is left.  Repeated rows are all
    returned, no rows give none.
    """
    rows = _cleaned(docs, min_sites, site)
    own = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return rows.select(*own, "n_lines", "n_removed")


def clean_documents(docs: DataFrame, min_sites: int = 10, site: str = "source") -> DataFrame:
    """`remove_boilerplate` without the counts: the columns of `docs`."""
    return _cleaned(docs, min_sites, site).select("row.*")


def _cleaned(docs: DataFrame, min_sites: int, site: str) -> DataFrame:
    """All columns of docs as `row`, its text rewritten; `n_lines` and `n_removed`."""
    scratch = Scratch(docs.sparkSession)
    key = row_key(F.col("text"))
    keyed = docs.select(*key, F.col("doc_id").alias("id"), F.col(site).cast("string").alias("site"), "text")
    lines = scratch.stage(line_rows(keyed, "k1", "k2", "id", "site"))
    common = scratch.stage(boilerplate(lines, min_sites))
    # places to remove, once per document (rows of equal id and text share them)
    hits = lines.select("k1", "k2", "id", "at", "h1", "h2").join(common, ["h1", "h2"])
    gone = hits.groupBy("k1", "k2", "id").agg(F.collect_set("at").alias("places"))
    rows = as_row(docs, k1=key[0], k2=key[1], id=F.col("doc_id"))
    same = (rows["k1"] == gone["k1"]) & (rows["k2"] == gone["k2"]) & rows["id"].eqNullSafe(gone["id"])
    rows = rows.join(gone, same, "left").select("row", "places")
    split = F.split("row.text", "\n")
    left = F.filter(F.transform(split, lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda x: ~F.array_contains("places", x["at"]))
    rest = F.array_join(F.transform(left, lambda x: x["line"]), "\n")
    text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(rest)
    return rows.select(
        F.col("row").withField("text", text).alias("row"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_removed"),
    )
