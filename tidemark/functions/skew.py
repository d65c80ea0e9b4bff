"""Joins that stay balanced when single keys hold a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than KEY_ROWS rows and more than one row in HOT_SHARE. Fewer than
# HOT_SHARE keys can be, so what is broadcast is bounded, and every other key is bounded in rows: by
# KEY_ROWS up to KEY_ROWS * HOT_SHARE rows in all, by a hundred-thousandth of the rows beyond.
KEY_ROWS = 100_000
HOT_SHARE = 100_000


def join_per_key(
    facts: DataFrame,
    per_key: DataFrame,
    key: str,
    rows: str,
    key_rows: int = KEY_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Inner join of ``facts`` with ``per_key``, which has one row per key and counts in ``rows``
    how many facts that key has.

    Adaptive skew handling does not reach a join whose one side is an aggregate, so a key with a
    third of all facts would land in one task. The counts tell the hot keys exactly; these are
    broadcast and joined where the facts lie. All other keys are joined by shuffle, and the rows of
    one of them fit a task.

    The columns of ``per_key`` travel as one struct, so that every use asks for the same columns and
    its aggregation is run once and reused; the number of facts is the sum of its counts.
    """
    columns = [c for c in per_key.columns if c != key]
    packed = per_key.select(key, F.struct(*columns).alias("per_key"))
    total = packed.agg(F.sum(f"per_key.{rows}")).scalar()
    is_hot = (F.col(f"per_key.{rows}") > key_rows) & (F.col(f"per_key.{rows}") * hot_share > total)
    with_hot = facts.join(F.broadcast(packed.filter(is_hot)), key, "left")
    near = with_hot.filter(F.col("per_key").isNotNull())
    far = with_hot.filter(F.col("per_key").isNull()).drop("per_key")
    joined = near.unionByName(far.join(packed.filter(~is_hot), key))
    return joined.select(*facts.columns, "per_key.*")


#: Slices of one key's rows at most.
SLICES = 200


def last_before(
    rows: DataFrame, key: str, order: Sequence[str], value: str, key_rows: int = KEY_ROWS, slices: int = SLICES
) -> DataFrame:
    """``rows`` with ``value`` filled from the last row of the key, up to the row itself, that has one.

    ``order`` begins with a number; rows alike in all of it are in no order. ``value`` must be a struct,
    so that a null means no value. A window per key would give a key with a third of all rows to one
    task. So keys beyond ``key_rows`` are cut by quantiles of the first order column, the window runs
    within a slice, and each slice starts from the last value of the slices before it: one row per slice
    of a hot key, which is broadcast. ``rows`` are read several times and should be stored.
    """
    first, named = order[0], f"last_{value}"
    inside = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > key_rows)
    most = counts.agg(F.max("n")).first()[0]
    if most is None:
        return rows.withColumn(value, F.last(value, ignorenulls=True).over(inside.partitionBy(key)))
    pieces = min(slices, math.ceil(most / key_rows))
    every = F.greatest(F.lit(1), F.floor(F.lit(pieces * key_rows) / F.col("n")))
    hot = rows.join(F.broadcast(counts), key).groupBy(key, "n").agg(
        F.percentile_approx(first, [i / pieces for i in range(1, pieces)]).alias("edges")
    )
    edges = F.array_distinct(F.filter("edges", lambda _, i: (i + 1) % every == 0))
    hot = hot.select(key, edges.alias("edges"))
    cut = F.when(F.col("edges").isNull(), 0).otherwise(F.size(F.filter("edges", lambda e: e < F.col(first))))
    marked = rows.join(F.broadcast(hot), key, "left").withColumn("slice", cut)
    known = marked.filter(F.col("edges").isNotNull() & F.col(value).isNotNull()).groupBy(key, "slice")
    known = known.agg(F.max_by(value, F.struct(*order)).alias(named))
    all_slices = hot.select(key, F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("slice"))
    earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = all_slices.join(known, [key, "slice"], "left")
    carry = carry.select(key, "slice", F.last(named, ignorenulls=True).over(earlier).alias(named))
    filled = marked.withColumn(value, F.last(value, ignorenulls=True).over(inside.partitionBy(key, "slice")))
    met = filled.join(F.broadcast(carry), [key, "slice"], "left")
    return met.withColumn(value, F.coalesce(value, named)).select(*rows.columns)
