"""Enrichment, anomalies, restocking and behaviour changes on top of changes and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key, last_before
from tidemark.operators.changes import stock_changes
from tidemark.session import stored


def enrich_changes(changes: DataFrame, customers: DataFrame) -> DataFrame:
    """Order changes with the name and email of the customer, where known.

    No broadcast is forced: customers below ``spark.sql.autoBroadcastJoinThreshold`` are broadcast,
    larger ones are joined by shuffle, where adaptive execution splits a customer with very many
    changes (both inputs are plain shuffles, which is what skew handling needs).
    """
    row = F.coalesce("after_data", "before_data")
    orders = changes.select(
        row["id"].alias("order_id"),
        row["customer_id"].alias("customer_id"),
        row["total_amount"].alias("total_amount"),
        row["status"].alias("status"),
        "operation",
        "source_timestamp",
    )
    known = customers.select(
        F.col("id").alias("customer_id"), "first_name", "last_name", "email"
    )
    return orders.join(known, "customer_id", "left")


def enrich_changes_as_of(changes: DataFrame, customer_changes: DataFrame) -> DataFrame:
    """Order changes with the customer as it was when the order changed.

    The customer's last change up to that time counts, at equal times too, that with the largest offset;
    behind a deletion, and before the first change, the customer is unknown. Both histories become
    one, in order of customer and time, in which each order takes the last version before it: a sort per
    customer, no join of ranges. Customers of any size are spread, see ``skew.last_before``.
    """
    row = F.coalesce("after_data", "before_data")
    order = F.struct(
        row["id"].alias("order_id"), row["total_amount"].alias("total_amount"), row["status"].alias("status"), "operation"
    )
    image = F.when(F.col("operation") != "d", F.struct("after_data.first_name", "after_data.last_name", "after_data.email"))
    orders = changes.select(
        row["customer_id"].alias("customer_id"), "source_timestamp", F.lit(1).alias("side"), "offset", order.alias("order")
    )
    versions = customer_changes.select(
        row["id"].alias("customer_id"), "source_timestamp", F.lit(0).alias("side"), "offset", F.struct(image.alias("image")).alias("version")
    )
    both = stored(orders.unionByName(versions.filter("customer_id IS NOT NULL"), allowMissingColumns=True), "as-of")
    named = both.filter("customer_id IS NOT NULL")
    met = last_before(named, "customer_id", ["source_timestamp", "side", "offset"], "version").filter("side = 1")
    met = met.unionByName(both.filter("customer_id IS NULL"))
    return met.select("customer_id", "order.*", "source_timestamp", "version.image.*")


MOMENTS = "row_key bigint, order_count bigint, mean_amount double, m2 double"


def transaction_anomalies(
    orders: DataFrame, deviations: float = 2.0, minimum_orders: int = 5
) -> DataFrame:
    """Orders above their customer's mean by more than ``deviations`` sample standard deviations,
    for customers with at least ``minimum_orders`` orders.
    """
    amount = F.col("total_amount").cast("double")
    usual = (
        orders.groupBy("customer_id")
        .agg(
            F.count("total_amount").alias("order_count"),
            F.avg(amount).alias("mean_amount"),
            F.stddev_samp(amount).alias("deviation"),
        )
        .filter(F.col("order_count") >= minimum_orders)
    )
    placed = orders.select(F.col("id").alias("order_id"), "customer_id", "total_amount")
    limit = F.col("mean_amount") + deviations * F.col("deviation")
    return (
        join_per_key(placed, usual, "customer_id", "order_count")
        .filter(amount > limit)
        .select("order_id", "customer_id", "total_amount", "order_count", "mean_amount", "deviation")
    )


def order_moments(orders: DataFrame) -> DataFrame:
    """row_key (the customer), order_count, mean_amount and m2, the sum of squares around the mean: what a
    mean and a deviation follow from, and what can be merged.
    """
    amount = F.col("total_amount").cast("double")
    named = orders.filter(F.col("customer_id").isNotNull() & F.col("total_amount").isNotNull())
    return named.groupBy(F.col("customer_id").alias("row_key")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg(amount).alias("mean_amount"),
        (F.var_pop(amount) * F.count(F.lit(1))).alias("m2"),
    )


def merged_moments(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Moments of both parts together, by the difference of the means, which loses no digits."""
    a, b = (df.select("row_key", F.struct("order_count", "mean_amount", "m2").alias(s)) for df, s in ((kept, "a"), (new, "b")))
    met = a.join(b, "row_key", "full")
    n, apart = F.col("a.order_count") + F.col("b.order_count"), F.col("b.mean_amount") - F.col("a.mean_amount")
    both = F.struct(
        n.alias("order_count"),
        (F.col("a.mean_amount") + apart * F.col("b.order_count") / n).alias("mean_amount"),
        (F.col("a.m2") + F.col("b.m2") + apart * apart * F.col("a.order_count") * F.col("b.order_count") / n).alias("m2"),
    )
    return met.select("row_key", F.when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("a")).otherwise(both).alias("x")).select("row_key", "x.*")


def anomalies_from_moments(
    orders: DataFrame, moments: DataFrame, deviations: float = 2.0, minimum_orders: int = 5
) -> DataFrame:
    """As ``transaction_anomalies``, with limits from kept moments: only the orders asked for are read."""
    usual = moments.filter(F.col("order_count") >= minimum_orders).select(
        F.col("row_key").alias("customer_id"),
        "order_count",
        "mean_amount",
        F.sqrt(F.col("m2") / F.nullif(F.col("order_count") - 1, F.lit(0))).alias("deviation"),
    )
    placed = orders.select(F.col("id").alias("order_id"), "customer_id", "total_amount")
    limit = F.col("mean_amount") + deviations * F.col("deviation")
    return (
        join_per_key(placed, usual, "customer_id", "order_count")
        .filter(F.col("total_amount").cast("double") > limit)
        .select("order_id", "customer_id", "total_amount", "order_count", "mean_amount", "deviation")
    )


def restock_alerts(changes: DataFrame, threshold: int = 10) -> DataFrame:
    """Products whose stock falls from ``threshold`` or more to below it."""
    return stock_changes(changes).filter(
        (F.col("old_stock") >= threshold) & (F.col("new_stock") < threshold)
    )


def customer_activity_change(events: DataFrame, period: str = "week") -> DataFrame:
    """Events per user and period, those of the period before, and the difference.

    A period without events is reported once, as the fall to zero behind an active one, up to the
    last period on record. Counting comes first: each active period then brings two rows, for itself
    and for its successor, which are summed; nothing is gathered per user.
    """
    counts = events.groupBy(
        "user_id", F.date_trunc(period, "ts").cast("date").alias("period_start")
    ).agg(F.count(F.lit(1)).alias("event_count"))
    last = counts.agg(F.max("period_start").alias("last")).scalar()
    following = F.date_trunc(
        period, F.col("period_start").cast("timestamp_ntz") + F.expr(f"INTERVAL 1 {period}")
    ).cast("date")
    none = F.lit(0).cast("bigint")
    own = F.struct("period_start", "event_count", none.alias("previous_count"))
    next_ = F.struct(
        following.alias("period_start"),
        none.alias("event_count"),
        F.col("event_count").alias("previous_count"),
    )
    moved = counts.select("user_id", F.inline(F.array(own, next_)))
    return (
        moved.filter(F.col("period_start").isNull() | (F.col("period_start") <= last))
        .groupBy("user_id", "period_start")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("previous_count").alias("previous_count"),
        )
        .filter((F.col("event_count") > 0) | (F.col("previous_count") > 0))
        .withColumn("difference", F.col("event_count") - F.col("previous_count"))
    )
