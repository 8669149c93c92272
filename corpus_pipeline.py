"""The corpus pipeline: STAGES applied to `documents`, each to all that the one before kept.

1. quality rules   documents that fail the base rules or are depleted leave; lines
                   above the limits of their host are removed from the others
2. line dedup      lines that many sites share are removed
3. near-dedup      one document of each SimHash group stays
4. mixing          documents are repeated as the mix of sources asks
5. packing         every document's pieces get their length bucket and batch
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revbridge.llm import line_dedup, mixing, packing, quality_rules, simhash
from revbridge.llm.common import Scratch
from revbridge.llm.queries import MIN_SITES, MIX_CYCLE, MIX_EPOCHS, PACK_BUCKETS, PACK_BUDGET, PACK_LEN, RADIUS, SHINGLE, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs, MIN_SITES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, SHINGLE, RADIUS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_corpus(docs, MIX_CYCLE, MIX_EPOCHS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = packing.pack(docs.select("doc_id", "text"), PACK_LEN, PACK_BUCKETS, PACK_BUDGET)
    rows = packing.piece_text(rows, PACK_LEN)
    return rows.select("doc_id", "piece", "n_tokens", "bucket_len", "batch", "padding", "text")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: The near-dedup stage hashes with XXH64, which SQL lacks: tests hold `run` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written to the shared folder and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.stage(docs)
    return docs
