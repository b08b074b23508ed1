"""A training corpus from ``documents``: clean of toxicity, near-duplicates and benchmark text,
mixed to target weights and written as token ids.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it and reads it back
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abacus.llm import decontaminate, lsh_forest, mixing, token_blocks, toxicity
from abacus.llm._store import written
from abacus.session import scratch_path

# Workers of the token stage share their executors with what other stages left, so they hold few
# pieces and encode little at a time.
TOKEN_MEMORY = {"between_tasks": 50_000, "most": 150_000, "slice_bytes": 1 << 20}


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below one half by the classifier that the labelled rows train."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out="__score").where("__score < 0.5").select(*docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the smallest id of each class of near-duplicates, one row of each id; rows
    without words or without an id, which are in no class, all stay."""
    judged = lsh_forest.near_duplicates(docs)
    gone = judged.where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    # Repeated rows of one id with words are copies of each other.
    twice = judged.where("kept and doc_id is not null and n_links > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, "doc_id", "left_anti").unionByName(again).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of a benchmark item."""
    found = decontaminate.with_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "__found")
    return found.where("not __found.contaminated").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix visits them; the budget is the least that visits all."""
    return mixing.mix(docs, budget_share=None, details=False)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row, read back from the written ids."""
    path = scratch_path(spark, "pipeline-tokens")
    token_blocks.write_tokens(docs, path, **TOKEN_MEMORY)
    return token_blocks.digests(token_blocks.read_tokens(spark, path))


STAGES = [("toxicity", toxicity_filter), ("ngram_join", near_duplicate_filter), ("decontamination", decontamination),
          ("mixing", source_mix), ("token_output", token_output)]

# Trained scores and tokenizer ids cannot be stated in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
