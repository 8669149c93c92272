"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revbridge.llm import ann, hard_negatives, license_scan, line_dedup, merkle, mixing, ngram_lm, packing, quality_rules, sharding, simhash, suffix_dedup, url_filter
from revbridge.llm.common import ascii_lower

N_SHARDS = 64
MIN_SITES = 10
SHINGLE, RADIUS = 3, 2
MIX_CYCLE, MIX_EPOCHS = (1, 2, 3), 3
PACK_LEN, PACK_BUCKETS, PACK_BUDGET = 4096, 12, 65536
QUERY_EVERY, NEIGHBOURS = 50, 5
REPEAT_BYTES = 200
ANCHOR_EVERY, RELABEL_EVERY = 100, 7

#: The URL rules of the contract (fixed values).
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard, by its doc_id."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign(docs, [F.col("doc_id")], sharding.shard_names(N_SHARDS)).select("doc_id", "slot", "shard")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents")
    out = simhash.near_duplicates(docs, simhash.Scratch(spark), SHINGLE, RADIUS)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, lines removed as cross-site boilerplate, and MD5 of what is left."""
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), MIN_SITES)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"), F.md5("text").alias("text_md5"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signatures of every document."""
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict of cross-document line frequency of every document."""
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def toxic_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of pages whose path ends in the doc_id of a document labelled toxic."""
    pages = table(spark, sf_dir, "pages").select("url")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    pages = pages.select(url_filter.canonical(host, path).alias("canonical_url"))
    pages = pages.withColumn("doc_id", F.regexp_extract("canonical_url", "/([0-9]{1,18})$", 1)).filter("doc_id != ''")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("doc_id"))
    return pages.join(toxic, "doc_id", "left_semi").select("canonical_url")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    out = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), toxic_urls(spark, sf_dir), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its strings of 200 bytes that also start elsewhere."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed to their weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix_sources(docs, MIX_CYCLE, MIX_EPOCHS)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and padding of every piece of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack(docs, PACK_LEN, PACK_BUCKETS, PACK_BUDGET)
    return out.select("doc_id", "piece", "n_tokens", "bucket_len", "batch", "padding")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0, NEIGHBOURS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 hardest negatives of each of the 5 positives of every 100th vector; every 7th label is moved on."""
    vec_id, label = F.col("vec_id"), F.col("label")
    label = F.when(vec_id % RELABEL_EVERY == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % ANCHOR_EVERY == 0, label)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that its tampered leaf gives."""
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    tampered = {"text": F.when(F.crc32(doc_id) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))}
    out = merkle.manifest(docs, tampered=tampered)
    folded = merkle.fold(F.col("other_leaf"), F.col("path"))
    out = out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document by words and by the model, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = ngram_lm.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    return out.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over `documents`."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sharding, op2_simhash, op3_line_dedup, op4_license_scan, op5_quality_rules,
        op6_url_filter, op7_suffix_dedup, op8_mixing, op9_packing, op10_nearest, op11_hard_negatives, op12_manifest, op13_lm_score, pipeline,
    )
    return {f.__name__: f for f in own}
