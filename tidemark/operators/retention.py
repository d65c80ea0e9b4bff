"""Cohort retention: how many users of a signup day are active n days later.

Input: user_id, signup_time, activity_time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_days(activity: DataFrame) -> DataFrame:
    """One row per user, signup day and active day.

    Retention counts distinct users only, so folding each user's activity to days first keeps the
    result and lets map-side aggregation absorb a user with very many activities. Both aggregates
    below read this one shuffle.
    """
    return activity.select(
        "user_id",
        F.to_date("signup_time").alias("signup_date"),
        F.to_date("activity_time").alias("activity_date"),
    ).distinct()


def _sizes(days: DataFrame) -> DataFrame:
    return days.groupBy("signup_date").agg(F.count_distinct("user_id").alias("cohort_size"))


def _retained(days: DataFrame) -> DataFrame:
    return (
        days.filter(F.col("activity_date") >= F.col("signup_date"))
        .withColumn("day_diff", F.datediff("activity_date", "signup_date"))
        .groupBy("signup_date", "day_diff")
        .agg(F.count_distinct("user_id").alias("retained_users"))
    )


def cohort_sizes(activity: DataFrame) -> DataFrame:
    """Distinct users per signup day, whenever they were active."""
    return _sizes(user_days(activity))


def daily_retention(activity: DataFrame) -> DataFrame:
    """Distinct users per signup day and days since signup; activity before signup is ignored."""
    return _retained(user_days(activity))


def cohort_retention(activity: DataFrame) -> DataFrame:
    """Retained users, cohort size and their ratio per signup day and days since signup.

    A cohort without any activity on or after its signup day does not appear.
    """
    days = user_days(activity)
    return (
        _retained(days)
        .join(_sizes(days), "signup_date")
        .select(
            "signup_date",
            "day_diff",
            "retained_users",
            "cohort_size",
            (F.col("retained_users").cast("double") / F.col("cohort_size")).alias("retention_rate"),
        )
        .orderBy("signup_date", "day_diff")
    )
