"""A training corpus from documents in five stages, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and
gives what was written to the next. All but the last return the columns of documents.

In all stages null and empty texts are rows like others, repeated rows are judged each for itself, a null doc_id stays
null and is compared as its operator says, very long texts are read whole, an empty table stays
empty, and further columns, whatever their names, are kept as they are. What a stage does with such texts is said at its
operator: quality rules reject empty ones, and of equal or near texts one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftvault.llm import exact_dedup, packing, quality_rules, simhash_dedup, toxicity
from driftvault.llm.common import stage
from driftvault.sources import shared

import public_tokenizers  # after driftvault.llm: where that is missing, nothing else is asked for


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_quality(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; the classifier learns from the labels of those at hand."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return simhash_dedup.keep_near(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("toxicity", clean), ("exact dedup", exact), ("near dedup", near), ("packing", packed)]

#: SQL has no classifier and no tokenizer. tests/llm runs each stage and run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What the operators staged, and each stage's input, goes when its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared.mark()
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        shared.release(spark, before, keep=(shared.latest(),))
    return docs
