"""Exact distinct counts that are kept as bitmaps, so that a new day is added without reading the past.

A cell holds the users of one signup day that were active on one day, as bitmaps of 32,768 users each:
bit and bitmap follow from the user's number. Bitmaps of the same users are united bit by bit, so
cells of any writes can be merged, in any order and as often as one likes, and counts stay exact. Cells
of an active day are one partition: a run for a day writes that partition alone, late activity of an
earlier day rewrites only its own. User numbers should be dense, as sequences give them: a bitmap takes
4 KB however few users it holds.

Input: user_id (a number), signup_time, activity_time; rows without one of them belong to no cell.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import snapshots

CELLS = "signup_date date, part bigint, users binary, activity_date date"


def cells(activity: DataFrame) -> DataFrame:
    """signup_date, part, users and activity_date: the bitmaps of the users active on each day.

    Users are set in bitmaps per task first, so a day with most of the activity is still spread.
    """
    dated = activity.select(
        F.to_date("signup_time").alias("signup_date"),
        F.to_date("activity_time").alias("activity_date"),
        F.bitmap_bucket_number(F.col("user_id").cast("bigint")).alias("part"),
        F.bitmap_bit_position(F.col("user_id").cast("bigint")).alias("bit"),
    ).dropna()
    found = dated.groupBy("signup_date", "part", "activity_date").agg(F.bitmap_construct_agg("bit").alias("users"))
    return found.select(*schemas.struct(CELLS).fieldNames())


def united(found: DataFrame) -> DataFrame:
    """Cells of several writes, each once."""
    merged = found.groupBy("signup_date", "part", "activity_date").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.select(*schemas.struct(CELLS).fieldNames())


def add(activity: DataFrame, path: str) -> list[dt.date]:
    """Add activity to the kept cells; gives the days it has. Activity that is there already changes nothing.

    Days that the table does not have are written without reading it.
    """
    spark = activity.sparkSession
    now = snapshots.latest(spark, path)
    new = cells(activity)
    days = [r[0] for r in new.select("activity_date").distinct().collect()]
    known = [f for d in days if (f := f"activity_date={d}") in now.folders]
    if known:
        new = united(new.unionByName(snapshots.read(spark, path, schemas.struct(CELLS), now, known)))
    written = snapshots.stage(new.hint("rebalance", "activity_date"), path, now.number + 1, ["activity_date"])
    folders = now.folders | {f: [now.number + 1] for f in written}
    snapshots.publish(spark, path, snapshots.Snapshot(now.number + 1, folders))
    snapshots.tidy(spark, path)
    return sorted(days)


def kept(spark: SparkSession, path: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """The kept cells, or those of some active days."""
    partitions = None if days is None else [f"activity_date={d}" for d in days]
    return snapshots.read(spark, path, schemas.struct(CELLS), partitions=partitions)


def _counted(found: DataFrame, *by: str) -> DataFrame:
    """Distinct users per group, united per part of the numbers first."""
    merged = found.groupBy(*by, "part").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("users"))


def cohort_sizes(found: DataFrame) -> DataFrame:
    """Distinct users per signup day, whenever they were active."""
    return _counted(found, "signup_date").withColumnRenamed("users", "cohort_size")


def daily_retention(found: DataFrame) -> DataFrame:
    """Distinct users per signup day and days since signup; activity before signup is ignored."""
    later = found.filter(F.col("activity_date") >= F.col("signup_date"))
    later = later.withColumn("day_diff", F.datediff("activity_date", "signup_date"))
    return _counted(later, "signup_date", "day_diff").withColumnRenamed("users", "retained_users")


def cohort_retention(found: DataFrame) -> DataFrame:
    """Retained users, cohort size and their ratio per signup day and days since signup."""
    rate = (F.col("retained_users").cast("double") / F.col("cohort_size")).alias("retention_rate")
    met = daily_retention(found).join(cohort_sizes(found), "signup_date")
    return met.select("signup_date", "day_diff", "retained_users", "cohort_size", rate).orderBy("signup_date", "day_diff")


def active_users(found: DataFrame) -> DataFrame:
    """Distinct users per active day."""
    return _counted(found, "activity_date").withColumnRenamed("users", "unique_users")
