"""The corpus pipeline: rules, classifier, near-duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.llm.common import saved
from bugsieve.llm.cotraining import keep_by_classifier
from bugsieve.llm.packing import pack
from bugsieve.llm.passages import remove_repeated_passages
from bugsieve.llm.rules import keep_by_rules
from bugsieve.llm.simhash import one_of_each_component

#: Shingle length and distance of the near-duplicate stage.
SHINGLE_WORDS, MAX_BITS = 3, 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base checks and the learned rules keep."""
    return keep_by_rules(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; it learns from the labelled documents of
    the tables, since the rules have left few bad ones in ``docs``."""
    return keep_by_classifier(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return one_of_each_component(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the passages that a document with a smaller id keeps; n_chars follows."""
    cut = remove_repeated_passages(docs)
    length = F.when(F.col("removed_chars") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences that hold every token of the documents once."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: SQL has no learned models, gear hashes or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each over the table that the one before it wrote."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
