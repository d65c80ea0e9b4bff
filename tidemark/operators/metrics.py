"""Change counts per time window, for streams and for history alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _windowed(ops: DataFrame, keys: list[str], width: str, lateness: str) -> DataFrame:
    return (
        ops.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width).alias("span"), *keys)
        .agg(F.count(F.lit(1)).alias("change_count"))
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            *keys,
            "change_count",
        )
    )


def change_metrics(ops: DataFrame, width: str = "1 minute", lateness: str = "1 minute") -> DataFrame:
    """Changes per window, table and operation. For update (or append) output mode: windows that end
    before the watermark are closed, and later rows for them are dropped.
    """
    return _windowed(ops, ["table_name", "operation"], width, lateness)


def op_stats(
    ops: DataFrame, width: str = "1 minute", lateness: str = "1 minute", ordered: bool = True
) -> DataFrame:
    """Changes per window and operation, in window order.

    A stream can be sorted in complete mode only. Complete mode keeps every window in state and
    counts rows however late; for an unbounded run use ``ordered=False`` with update mode.
    """
    stats = _windowed(ops, ["operation"], width, lateness)
    return stats.orderBy("window_start") if ordered else stats


def sorted_stats(batch: DataFrame) -> DataFrame:
    """All windows of a complete-mode micro-batch in time order.

    The same order as ``op_stats(ordered=True)``, but applied to the finished batch: a sort inside
    the stream samples its input first and so evaluates the state store twice.
    """
    return batch.orderBy("window_start")


def latest_metrics(batches: DataFrame, keys: list[str]) -> DataFrame:
    """The last emitted count per window and key, from a table of update-mode micro-batches."""
    return batches.groupBy("window_start", "window_end", *keys).agg(
        F.max_by("change_count", "batch_id").alias("change_count")
    )


def kept_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a ``change_metrics`` stream still holds, with their counts, from its checkpoint alone: what a
    restart would go on from, to be set against a count of the history.
    """
    held = spark.read.format("statestore").load(checkpoint)
    return held.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        "key.table_name",
        "key.operation",
        F.col("value.count").alias("change_count"),
    )
