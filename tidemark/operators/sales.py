"""Daily sales: extract, validate, measure, report, retain.

The day is always an argument (``as_of``), so that a run can be repeated. Dates are compared as
ranges on the stored timestamp, which lets them reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.numeric import money_avg, money_sum


def _day(as_of: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def _midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp")


def staging_sales(df: DataFrame) -> DataFrame:
    """``df`` brought to the staging columns and types."""
    fields = schemas.struct(schemas.STAGING_SALES).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def extract_daily_sales(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """The raw sales of one day, stamped with it; without a day, every sale with its own day."""
    if as_of is None:
        dated = raw.filter(F.col("created_at").isNotNull())
        return staging_sales(dated.withColumn("sale_date", F.to_date("created_at")))
    day = _day(as_of)
    created = F.col("created_at")
    of_day = (created >= _midnight(day)) & (created < _midnight(day + dt.timedelta(days=1)))
    return staging_sales(raw.filter(of_day).withColumn("sale_date", F.lit(day)))


def daily_metrics(staging: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Transactions, revenue, mean value and distinct customers per day (or for one day).

    Distinct customers are found in two steps, per day and customer and then per day, so a day
    with most of the sales is still spread over many tasks.
    """
    if as_of is not None:
        staging = staging.filter(F.col("sale_date") == F.lit(_day(as_of)))
    value = F.col("quantity") * F.col("price")
    return staging.groupBy("sale_date").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_sum(value).alias("total_revenue"),
        money_avg(value).alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def retain_recent(staging: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Sales not created more than ``days`` days before ``as_of``; unknown times are kept."""
    cutoff = _midnight(_day(as_of) - dt.timedelta(days=days))
    created = F.col("created_at")
    return staging.filter((created >= cutoff) | created.isNull())


def daily_report(metrics: DataFrame) -> DataFrame:
    """The reported figures, latest day last."""
    return metrics.select(
        "sale_date",
        F.col("total_transactions").alias("transactions"),
        F.col("total_revenue").alias("revenue"),
        F.col("avg_transaction_value").alias("average_value"),
        "unique_customers",
    ).orderBy("sale_date")
