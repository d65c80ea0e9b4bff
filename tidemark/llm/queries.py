"""The operators as queries over a folder of test tables, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, embeddings, mixing, packing, pii, prefix_trie, quality, rules, secret_scan, simhash, suffix_dedup, vector_codes, warc,
)
from tidemark.session import scratch_dir
from tidemark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, "documents", sf_dir))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, "documents", sf_dir)
    return quality.score(docs, quality.fit(docs, table(spark, "labels", sf_dir)))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, "documents", sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, "documents", sf_dir))


def op5_itq_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, "embeddings", sf_dir))


def op6_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, "documents", sf_dir), table(spark, "labels", sf_dir))


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, "documents", sf_dir)
    return pii.find(docs, pii.fit(docs))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, "documents", sf_dir))


def op9_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, "pages", sf_dir), scratch_dir(spark, "warc"))
    return warc.read_bundles(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, "documents", sf_dir))


def op11_anchor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, "embeddings", sf_dir))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, "documents", sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, "conversations", sf_dir))


def all_queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
