"""Kafka-shaped records kept in files, read back as a stream or as history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


def _for_topics(records: DataFrame, topics: str | Sequence[str] | None) -> DataFrame:
    if topics is None:
        return records
    wanted = [t.strip() for t in topics.split(",")] if isinstance(topics, str) else list(topics)
    return records.filter(F.col("topic").isin(wanted))


def write_records(records: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add records to a replay directory; each call's files count as newly arrived."""
    records.write.format(fmt).mode("append").save(path)


def replay_stream(
    spark: SparkSession,
    path: str,
    topics: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Unbounded records: files are consumed oldest first as they appear below ``path``."""
    reader = spark.readStream.format(fmt).schema(schemas.struct(schemas.RECORD))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _for_topics(reader.load(path), topics)


def replay_history(
    spark: SparkSession,
    path: str,
    topics: str | Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """All records below ``path`` as a bounded frame."""
    reader = spark.read.format(fmt).schema(schemas.struct(schemas.RECORD))
    return _for_topics(reader.load(path), topics)
