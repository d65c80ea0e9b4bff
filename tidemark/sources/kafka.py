"""Change streams and change history from Kafka.

Needs the spark-sql-kafka package on the classpath (spark-submit --packages). Everything downstream
works on the columns of ``schemas.RECORD`` and does not care where they come from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas


def _options(
    servers: str, topics: str | Sequence[str], extra: dict[str, str] | None
) -> dict[str, str]:
    subscribed = topics if isinstance(topics, str) else ",".join(topics)
    return {"kafka.bootstrap.servers": servers, "subscribe": subscribed, **(extra or {})}


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.struct(schemas.RECORD).fieldNames())


def change_stream(
    spark: SparkSession,
    servers: str,
    topics: str | Sequence[str],
    starting: str = "latest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Unbounded records of one or several topics, from ``latest`` or ``earliest``.

    ``options`` passes through further source settings, such as ``kafka.security.protocol``,
    ``maxOffsetsPerTrigger``, which bounds a micro-batch after a long stop, or ``minPartitions``,
    which splits a topic partition that holds most of the messages over several tasks.
    """
    reader = spark.readStream.format("kafka").options(**_options(servers, topics, options))
    return _columns(reader.option("startingOffsets", starting).load())


def change_history(
    spark: SparkSession,
    servers: str,
    topics: str | Sequence[str],
    start: str = "earliest",
    end: str = "latest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Bounded records between two offsets; by default everything the topics still hold."""
    reader = spark.read.format("kafka").options(**_options(servers, topics, options))
    return _columns(reader.option("startingOffsets", start).option("endingOffsets", end).load())
