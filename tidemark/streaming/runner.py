"""Start, await and stop streaming queries."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming import sinks
from tidemark.streaming.sinks import BatchFunction


def run_stream(
    df: DataFrame,
    write: BatchFunction,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``write``.

    ``checkpoint`` is mandatory: a restart with the same folder resumes after the last finished
    batch. ``mode`` is append, update or complete. ``every`` is a trigger interval such as
    ``"10 seconds"``; without it the query works off what is available and ends.

    The output of ``write`` is claimed for the query before its first batch; see ``sinks.claim``.

    ``state_partitions`` sizes the state of an aggregating query, which is fixed when the checkpoint
    is made and which adaptive execution does not resize. The session's shuffle partitions, made for
    large batch shuffles, would cost as many state files per micro-batch.
    """
    started, query_id = threading.Event(), []
    output = getattr(write, "output", None)

    def owned(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        if output and query_id:
            sinks.claim(batch.sparkSession, output, query_id[0])
        write(batch, batch_id)

    writer = df.writeStream.outputMode(mode).foreachBatch(owned).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    try:
        if state_partitions is None:
            query = writer.start()
        else:
            with _shuffle_partitions(df.sparkSession, state_partitions):
                query = writer.start()
        query_id.append(query.id)
    finally:
        started.set()
    return query


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """A query copies the session's settings as it starts, so this reaches that query only. Starts of
    sized queries wait for each other; other threads should not plan on this session meanwhile.
    """
    with _starting:
        yield from _set_partitions(spark, n)


_starting = threading.Lock()


def _set_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def drain(query: StreamingQuery) -> None:
    """Wait for a query started without a trigger interval; its failure is raised here."""
    query.awaitTermination()


def await_first(spark: SparkSession, timeout: int | None = None) -> None:
    """Wait until any query ends or fails, not for a particular one."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active query; returns their names or ids."""
    stopped = []
    for query in spark.streams.active:
        stopped.append(query.name or query.id)
        query.stop()
    return stopped
