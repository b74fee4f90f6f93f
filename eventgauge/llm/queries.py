"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventgauge.llm import (
    bpe_codec, chat_format, exact_dedup, jaccard_join, lattice_lm, packing, piece_sampling, prefix_trie, quality_rules, suffix_dedup,
    token_alignment, toxicity, warc,
)
from eventgauge.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality_rules.judged(documents, quality_rules.fitted(documents, table(spark, folder, "labels")))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_sentencepiece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return piece_sampling.sampled(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicated(table(spark, folder, "documents"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, folder, "documents"))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_lm.scored(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE))


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.joined(table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.write_and_read(table(spark, folder, "pages"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.scored(documents, toxicity.fitted(documents, table(spark, folder, "labels")))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    given = chat_format.turns(table(spark, folder, "conversations"))
    return chat_format.format_conversations(given.unionByName(added))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return token_alignment.aligned(documents, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op13_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.coded(table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE)))


def all_queries() -> dict[str, Query]:
    found = {name: held for name, held in globals().items() if name.startswith("op") and callable(held)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def all_statements() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.SQL, "op12_prefix_trie": prefix_trie.SQL}
