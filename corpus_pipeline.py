"""The corpus pipeline: five stages over documents, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiforge.llm import near_dedup, packing, quality_classifier, quality_rules, suffix_dedup
from lexiforge.llm.staging import Staging, scope, tidy

#: Word-shingle similarity, in percent, from which documents are near duplicates.
NEAR = 80


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return quality_classifier.keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules.keep_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_documents(docs, NEAR)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat."""
    return suffix_dedup.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of the documents' pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: The stages train, sort and pack, which SQL can't express.
ORACLE_SQL = None


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's result is written and reread.

    Null and empty texts, as all under ten words, are rejected by the rules; repeated rows are near duplicates of each
    other; rows that share a doc_id, or have none, are judged each by its own text; columns beyond those of
    documents are carried up to the last stage; empty tables give none.
    """
    staging = Staging(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scope():  # what a stage wrote for itself goes with it
            docs = staging.put(stage(spark, docs, sf_dir), name)
        if before:
            staging.drop(before)
        before = name
    return docs
