"""The corpus pipeline: five stages from documents to packed sequences.

Every stage takes all documents that the one before it kept, and its decisions take effect.
Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventgauge.llm import exact_dedup, jaccard_join, packing, suffix_dedup, toxicity
from eventgauge.llm.shared import stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the input table."""
    model = toxicity.fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.ordinary_documents(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("packing", packed_sequences),
]

#: The classifier and the similarity join cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
