"""From raw documents to packed training sequences: a fixed order of stages over whole tables.

Every stage works on all that the one before it kept. All but the last give the columns of
``documents``; the last gives where each piece of each document goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality, secret_scan, simhash
from tidemark.session import scratch_dir
from tidemark.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; it learns from ``docs`` and their labels."""
    return quality.accepted(docs, table(spark, "labels", sf_dir))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles within three bits."""
    return simhash.deduplicated(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by a mark."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences; a repeated document has as many."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("pu_quality", good_documents),
    ("golay_simhash", without_near_copies),
    ("secret_scan", without_secrets),
    ("source_mix", mixed),
    ("best_two_fit", packed),
]

#: SQL cannot express the classifier, the near copies, the scan and the tokens; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next one."""
    docs = table(spark, "documents", sf_dir)
    for name, stage in STAGES:
        out = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
