"""Tables rebuilt from their change history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Operations that create, read, update or delete a row.
ROW_OPERATIONS = ("c", "r", "u", "d")


def _positioned(changes: DataFrame, key: str) -> DataFrame:
    """Key, position, operation and the row image that stands for the row, of the changes that name one."""
    image = F.coalesce("after_data", "before_data")
    return changes.filter(_names_a_row(image[key])).select(
        image[key].alias("row_key"),
        "source_timestamp",
        "offset",
        "operation",
        image.alias("image"),
    )


def _names_a_row(key: Column) -> Column:
    return F.coalesce(F.col("operation").isin(*ROW_OPERATIONS) & key.isNotNull(), F.lit(False))


def set_aside(changes: DataFrame, key: str = "id") -> DataFrame:
    """operation and change_count of the changes that no row can be rebuilt from: of an operation
    that is no row change (such as a truncation), or without a key.
    """
    image = F.coalesce("after_data", "before_data")
    left = changes.filter(~_names_a_row(image[key]))
    return left.groupBy("operation").agg(F.count(F.lit(1)).alias("change_count"))


def _last_per_key(positioned: DataFrame) -> DataFrame:
    """``max_by`` keeps one candidate per key and task before the shuffle, so a row that changes
    very often does not gather in one place.
    """
    change = F.struct("source_timestamp", "offset", "operation", "image")
    last = F.max_by(change, F.struct("source_timestamp", "offset"))
    return positioned.groupBy("row_key").agg(last.alias("last")).select("row_key", "last.*")


def latest_changes(changes: DataFrame, key: str = "id") -> DataFrame:
    """The last change per row, ordered by source time and then by offset, deletions included.

    Keeping the position lets later changes be merged in: the latest of (latest so far and new
    changes) is the latest of all.
    """
    return _last_per_key(_positioned(changes, key))


def merge_latest(latest: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Bring an earlier ``latest_changes`` result up to date with further changes."""
    return _last_per_key(latest.unionByName(_positioned(changes, key)))


def live_rows(latest: DataFrame) -> DataFrame:
    """The rows of ``latest_changes`` that are not deleted."""
    return latest.filter(F.col("operation") != "d").select("image.*")


def current_state(changes: DataFrame, key: str = "id") -> DataFrame:
    """The rows a table holds after all changes; rows last deleted are absent."""
    return live_rows(latest_changes(changes, key))
