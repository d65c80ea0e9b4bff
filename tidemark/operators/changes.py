"""What changed: counts per operation, row images, and differences between before and after.

Input is the output of ``parse.changes`` (or ``parse_wrapped_changes`` for ``schema_versions``),
bounded or streaming. A difference needs both sides present: a value that appears from NULL or turns
into NULL is not reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _updates(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("operation") == "u")


def op_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("operation").agg(F.count(F.lit(1)).alias("change_count"))


def inserted_rows(changes: DataFrame) -> DataFrame:
    """Rows created or read by a snapshot, as they are afterwards."""
    return changes.filter(F.col("operation").isin("c", "r")).select("after_data.*")


def deleted_rows(changes: DataFrame) -> DataFrame:
    """Deleted rows as they were."""
    return changes.filter(F.col("operation") == "d").select("before_data.*")


def _emails(time: Column) -> list[Column]:
    return [
        F.col("before_data.id").alias("customer_id"),
        F.col("before_data.email").alias("old_email"),
        F.col("after_data.email").alias("new_email"),
        time,
    ]


def updated_emails(changes: DataFrame) -> DataFrame:
    """Old and new email of every customer update, changed or not."""
    return _updates(changes).select(*_emails(F.col("source_timestamp")))


def updated_emails_timed(changes: DataFrame) -> DataFrame:
    """As ``updated_emails``, with the time as text in whole seconds of the session time zone."""
    seconds = F.expr("source_timestamp div 1000")
    return _updates(changes).select(*_emails(F.from_unixtime(seconds).alias("change_time")))


def email_changes(changes: DataFrame) -> DataFrame:
    """Customer updates in which the email differs."""
    return (
        _updates(changes)
        .filter(F.col("before_data.email") != F.col("after_data.email"))
        .select(
            F.col("after_data.id").alias("customer_id"),
            F.col("after_data.first_name").alias("first_name"),
            F.col("after_data.last_name").alias("last_name"),
            F.col("before_data.email").alias("old_email"),
            F.col("after_data.email").alias("new_email"),
        )
    )


def _product_difference(changes: DataFrame, field: str, label: str) -> DataFrame:
    return (
        _updates(changes)
        .select(
            F.col("after_data.id").alias("product_id"),
            F.col("after_data.name").alias("product_name"),
            F.col(f"before_data.{field}").alias(f"old_{label}"),
            F.col(f"after_data.{field}").alias(f"new_{label}"),
        )
        .filter(F.col(f"old_{label}") != F.col(f"new_{label}"))
    )


def price_changes(changes: DataFrame) -> DataFrame:
    return _product_difference(changes, "price", "price")


def stock_changes(changes: DataFrame) -> DataFrame:
    moved = _product_difference(changes, "quantity_in_stock", "stock")
    return moved.withColumn("change", F.col("new_stock") - F.col("old_stock"))


def schema_versions(wrapped: DataFrame) -> DataFrame:
    return wrapped.select("schema_name", "schema_version").distinct()


def history_op_counts(changes: DataFrame) -> DataFrame:
    """Changes per operation and, with operation NULL, in total, from one pass over the history."""
    counts = op_counts(changes)
    return counts.rollup("operation").agg(F.sum("change_count").alias("change_count"))


def batch_volume(changes: DataFrame) -> DataFrame:
    """One row with the number of changes; zero for an empty batch."""
    return changes.agg(F.count(F.lit(1)).alias("change_count"))
