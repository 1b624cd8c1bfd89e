"""A corpus pipeline of five stages over ``documents``; each reads what its predecessor wrote, all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, common, decontaminate, pii, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules and the likelihood ratio keep."""
    return quality.clean(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, a Jaccard share of 0.8 or more) the document with the smallest doc_id, with all rows that bear it; rows without doc_id stay."""
    groups = simhash.similar_documents(docs)
    first = F.max(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    gone = groups.where("doc_id is not null").groupBy("doc_id").agg(first.alias("first")).where("not first").select("doc_id")
    return simhash.without_ids(docs, common.written(gone, "gone"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents into which no benchmark item leaks."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced; n_chars is counted anew."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their texts and the text that decoding gives back."""
    path = bpe.tokenizer_path()
    return bpe.round_trip(docs, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("PII", redaction), ("BPE encoding and decoding", encoding)]

#: The first stage hashes by XXH64, which SQL can't express; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = common.fresh_path(spark, "stage")
        with common.scratch(spark):  # what a stage wrote on its way goes once its result is written
            docs = common.written_at(stage(spark, docs, sf_dir), path)
        if before:
            common.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
