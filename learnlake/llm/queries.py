"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from learnlake.llm import (
    cover_tree,
    disclosure,
    language,
    longest_previous,
    merkle,
    mixing,
    order_minhash,
    packing,
    repetition,
    simhash,
    token_blocks,
    url_filter,
    wordpiece,
)
from learnlake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of_documents(documents(spark, sf_dir))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints_of_documents(documents(spark, sf_dir))


def op5_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_of_documents(documents(spark, sf_dir))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_of_documents(documents(spark, sf_dir))


def op7_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return wordpiece.token_counts(documents(spark, sf_dir), vocabulary, ["doc_id"])


def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(documents(spark, sf_dir))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longest_previous.deduplicated_documents(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_of_documents(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_url_filter, op3_simhash_near_dedup, op4_order_minhash, op5_repetition_quality,
    op6_source_mixing, op7_token_blocks, op8_packing, op9_token_counts, op10_pii_disclosure, op11_suffix_array_dedup,
    op12_merkle_manifest, op13_hard_negatives)}
ORACLES: dict[str, str] = {"op2_url_filter": url_filter.SQL, "op6_source_mixing": mixing.SQL, "op12_merkle_manifest": merkle.SQL,
    "op13_hard_negatives": cover_tree.SQL}
