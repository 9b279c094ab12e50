"""Corpus pipeline: quality classifier, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result to the shared checkpoint folder and reads it back as the next stage's documents,
so an executor lost in one stage never repeats an earlier one. All stages but the last
return the columns of ``documents``; the last returns the packed pieces.

Rows: a null or empty text has no words and is rejected by the rules; repeated rows of one
document leave one; a row without doc_id is never a duplicate; extra columns are carried
through; an empty table gives no pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barspark.llm import minhash, packing, rules, weak
from barspark.llm.common import Scratch, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer accepts."""
    return weak.classified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes."""
    return rules.passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids by power-of-two decomposition, with their ids."""
    return packing.pack(docs).drop("bucket")


STAGES = [("quality classifier", quality_classifier), ("quality rules", quality_rules),
          ("minhash near-dedup", near_duplicates), ("packing", pack)]

#: A trained scorer and a tokenizer are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
        if k > 0:
            scratch.drop(f"stage{k - 1}")
    return docs
