"""Registered queries of the corpus operators: each over the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chunks, decontam, huffman, jaccard, lines, quality, runs, secrets, sharding, suffix_tree, toxicity, whitening
from tidemark.llm.oracles import ORACLES  # noqa: F401  the SQL of these queries, for the entry points

TOKENIZER = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.encode("text", "utf-8"), F.lit(b""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).cast("long").alias("text_crc32")
    )
    sharded = sharding.shard_uniformly(rows, 16)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.substring_dedup(documents(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.lm_scores(documents(spark, sf_dir))


def op9_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.pack_ids(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(documents(spark, sf_dir))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.with_planted_tails(documents(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
    op1_quality_rules,
    op2_secret_scans,
    op3_ngram_jaccard_join,
    op4_benchmark_decontamination,
    op5_sharding,
    op6_bpe,
    op7_substring_dedup,
    op8_lm_scoring,
    op9_binary_ids,
    op10_toxicity,
    op11_line_dedup,
    op12_embedding_whitening,
    op13_periodic_runs,
    )
}
