"""URL filters: prefix rules, and a list of URLs behind a blocked Bloom filter.

The listed canonical URLs go into a Bloom filter of 512-bit blocks: a URL's hash
picks one block and a few bits in it, so a probe reads one row.  The filter is
built by a grouped bit_or over the blocks; its number of blocks follows the list
but never passes MAX_BLOCKS, so broadcasting it is bounded (a list too long for
that only makes more possible hits).  URLs that pass are joined exactly with the
list, which removes the false positives; the others never reach a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revbridge.llm.common import as_row, ascii_lower

#: 8 words of 64 bits a block; at most 2^18 blocks (16 MB) are broadcast.
WORDS = 8
MAX_BLOCKS = 1 << 18
BITS_PER_URL = 16
PROBES = 6


@dataclass(frozen=True)
class Rule:
    """`host` and its subdomains, paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (`rule`, `verdict`) of the longest rule that fits, or nulls.  Rules are
    tried longest first; equal lengths in the order of their names."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def canonical(host: Column, path: Column) -> Column:
    """One spelling for the addresses of a page: scheme, query and fragment are left out,
    and of the host a port and a leading `www.` or `m.`, of the path a trailing
    `index.html`, `.html` and slashes."""
    host = F.regexp_replace(host, r":[0-9]*$", "")
    host = F.regexp_replace(host, r"^(www|m)\.", "")
    path = F.regexp_replace(path, r"/index\.html?$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.html?$", "")
    return F.concat(host, path)


def _bits(url: Column) -> Column:
    """PROBES places (0 to 511) in a block, from one hash."""
    h = F.xxhash64(F.lit("bits"), url)
    return F.array(*[F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)).cast("int") for i in range(PROBES)])


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), url), F.lit(blocks)).cast("int")


def _word(bits: Column, w: int) -> Column:
    """The bits that lie in word w, as a long."""
    one = F.lit(1).cast("long")
    return F.aggregate(
        F.filter(bits, lambda b: F.shiftright(b, 6) == w), F.lit(0).cast("long"),
        lambda word, b: word.bitwiseOR(F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)))),
    )


def build_filter(urls: DataFrame, url: str, n_urls: int) -> tuple[DataFrame, int]:
    """The filter of a list of distinct URLs, rows (`block`, `w0`..`w7`), and its number of blocks."""
    blocks = max(1, min(MAX_BLOCKS, -(-n_urls * BITS_PER_URL // (64 * WORDS))))
    rows = urls.select(_block(F.col(url), blocks).alias("block"), _bits(F.col(url)).alias("bits"))
    rows = rows.select("block", *[_word(F.col("bits"), w).alias(f"w{w}") for w in range(WORDS)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)]), blocks


def possible_hits(df: DataFrame, url: str, bloom: DataFrame, blocks: int, out: str) -> DataFrame:
    """Add boolean `out`: false only if the URL is surely not listed."""
    probe = df.withColumns({"_block": _block(F.col(url), blocks), "_bits": _bits(F.col(url))})
    words = bloom.select(F.col("block").alias("_block"), F.array(*[f"w{w}" for w in range(WORDS)]).alias("_words"))
    joined = probe.join(F.broadcast(words), "_block", "left")
    one = F.lit(1).cast("long")
    # the hash may have no block: then nothing is listed there
    every = F.forall("_bits", lambda b: F.element_at("_words", F.shiftright(b, 6) + 1).bitwiseAND(F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)))) != 0)
    return joined.withColumn(out, F.col("_words").isNotNull() & F.coalesce(every, F.lit(False))).drop("_block", "_bits", "_words")


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add `host`, `path`, `canonical_url`, `rule` and `verdict` to every page.

    listed  a frame with a string column `canonical_url`; repeats and nulls in it
            do not matter.
    The longest fitting rule decides; where none fits, a page is blocked if its
    canonical URL is listed, else allowed.  A null url, or one without `://`, has
    an empty host and path, fits no rule, and is allowed unless the empty URL is
    listed.  Rows are never dropped, repeated rows are judged alike; columns named
    as the added ones are replaced.  A canonical URL that a third of all pages
    share is one row of the list, so the exact join may split its pages freely.
    """
    urls = listed.filter("canonical_url is not null").select("canonical_url").distinct()
    bloom, blocks = build_filter(urls, "canonical_url", urls.count())
    added = ("host", "path", "canonical_url", "rule", "verdict")
    rows = as_row(pages, *added, host=host_of(F.col(url)), path=path_of(F.col(url)))
    rows = rows.withColumn("canonical_url", canonical(F.col("host"), F.col("path")))
    rows = rows.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    rows = possible_hits(rows, "canonical_url", bloom, blocks, "possible")
    # only what the rules leave open and the filter lets pass is looked up
    ask = F.col("possible") & F.col("found").isNull()
    exact = urls.withColumnRenamed("canonical_url", "listed_url")
    open_rows = rows.filter(ask).join(exact, F.col("canonical_url") == F.col("listed_url"), "left")
    open_rows = open_rows.withColumn("listed", F.col("listed_url").isNotNull()).drop("listed_url")
    done = rows.filter(~ask).withColumn("listed", F.lit(False)).unionByName(open_rows)
    return done.withColumns({
        "rule": F.col("found.rule"),
        "verdict": F.coalesce(F.col("found.verdict"), F.when(F.col("listed"), "block").otherwise("allow")),
    }).select("row.*", *added)
