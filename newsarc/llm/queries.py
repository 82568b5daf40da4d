"""One query per operator, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsarc.llm import (ann, bfd_packing, decontaminate, katz, kk_packing, language, line_dedup, merkle, pii, quality,
                         sharding, simhash, spelling)
from newsarc.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes; equal texts share a shard."""
    return sharding.shard(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a verbatim window of the benchmark, and the items that occur."""
    out = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages."""
    return line_dedup.dedup_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "removed_chunks", "removed_words")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal numbers, dates and addresses replaced by pseudonyms."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document under a Katz model of the documents that are not held out."""
    return katz.scored(table(spark, sf_dir, "documents"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as rows of an id matrix with cumulative segment lengths and positions."""
    return bfd_packing.pack(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, learnt from the labels that are not held out."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048 ids."""
    return kk_packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learnt from the documents that are not held out."""
    return language.identify(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of each document, and whether its tampered copy still verifies."""
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents with each word's frequent spelling."""
    return spelling.variants(table(spark, sf_dir, "documents"))


# The key of the registered query; a user passes a secret one.
PII_KEY = "registered-query"

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_pii": op4_pii,
    "op5_simhash": op5_simhash,
    "op6_katz": op6_katz,
    "op7_token_ids": op7_token_ids,
    "op8_neighbours": op8_neighbours,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_language": op11_language,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
}
