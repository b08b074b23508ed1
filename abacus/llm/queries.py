"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacus.llm import (
    decontaminate, html_blocks, kk_shards, kronecker_negatives, lsh_forest, mixing, ns_kmeans, rp_forest, substring_dedup, token_blocks,
    toxicity, url_trees, warc,
)
from abacus.llm._vectors import integers
from abacus.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_blocks.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_blocks.digests(token_blocks.read_tokens(spark, path))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, pass, block, block_order, doc_order) of every visit of the mix."""
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "score")


def op9_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near-equal bytes; read back from the written files."""
    path = scratch_path(spark, "shards")
    kk_shards.write_shards(_table(spark, sf_dir, "documents"), path)
    text = F.coalesce("row.text", F.lit(""))
    rows = kk_shards.read_rows(spark, path).select(
        "row.doc_id", kk_shards.size_of(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "file", "place")
    return kk_shards.with_slots(rows, path).select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                                                   F.lit(None).cast("int").alias("grown_shard"))


def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integers(_table(spark, sf_dir, "embeddings"), "embedding", 256, "x", F.col("label").isNotNull())
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = rows.select(F.col("vec_id").alias("id"), moved.cast("long").alias("label"), "x")
    return kronecker_negatives.mine(points, F.col("id") % 100 == 0)


def op13_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_kmeans.cluster_embeddings(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_substring_dedup, op3_decontamination, op4_token_blocks, op5_warc, op6_mixing,
                                   op7_html_extraction, op8_url_filter, op9_embedding_forest, op10_ngram_join, op11_kk_shards,
                                   op12_kronecker_negatives, op13_ns_kmeans)}
