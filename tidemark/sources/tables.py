"""Parquet tables: scans, period-partitioned writes that may be repeated, and archive copies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources import snapshots


def table(spark: SparkSession, name: str, base: str | None = None, ddl: str | None = None) -> DataFrame:
    """A catalog table, or the Parquet table ``base/name.parquet`` when a folder is given."""
    if base is None:
        return spark.table(name)
    reader = spark.read
    if ddl:
        reader = reader.schema(schemas.struct(ddl))
    return reader.parquet(f"{base.rstrip('/')}/{name}.parquet")


def create_staging(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Register the staging table in the catalog, unless it is there already. Inserts that name no
    creation time get the present one.
    """
    where = f" LOCATION '{location}'" if location else ""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" + " DEFAULT current_timestamp()" * (f.name == "created_at")
        for f in schemas.struct(schemas.STAGING_SALES).fields
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (sale_date){where}")


def _period(column: Column | str, grain: str) -> Column:
    return F.trunc(column, grain) if grain != "day" else F.col(column)


def _partition(grain: str) -> str:
    return "sale_date" if grain == "day" else "sale_period"


def _folder(grain: str, period: dt.date) -> str:
    return f"{_partition(grain)}={period.isoformat()}"


def periods(spark: SparkSession, path: str, grain: str = "day") -> list[dt.date]:
    """The stored periods, from the snapshot alone."""
    mark = f"{_partition(grain)}="
    found = [f.removeprefix(mark) for f in snapshots.latest(spark, path).folders if f.startswith(mark)]
    return sorted(dt.date.fromisoformat(m) for m in found)


def _staged(df: DataFrame, path: str, grain: str, number: int) -> dict[str, list[int]]:
    """Write rows by period as version ``number``; gives the folders."""
    period = _partition(grain)
    if grain != "day":
        df = df.withColumn(period, _period("sale_date", grain))
    dealt = df.hint("rebalance", period).sortWithinPartitions(*dict.fromkeys([period, "sale_date"]))
    return {f: [number] for f in snapshots.stage(dealt, path, number, [period])}


def write_periods(
    df: DataFrame, path: str, grain: str = "day", days: Sequence[dt.date] | None = None
) -> None:
    """Replace the days given, or without them exactly the periods that occur in ``df``.

    With ``grain="day"`` the table is partitioned by ``sale_date``. A long history with few sales a
    day is better kept by ``"month"`` or ``"year"`` (partition ``sale_period``). A run for single days
    must name them: the other days of their periods are then kept, and a day that ``df`` has no rows
    for is emptied. Rows are in day order within a file either way, so a filter on ``sale_date`` skips
    row groups.

    All periods of a write become visible together, by one snapshot (``sources.snapshots``): a job that
    ends on the way has changed nothing, and readers see all days of before or all of after.

    Rebalancing lets adaptive execution pack small periods together and split a large one over
    several tasks, so neither many tiny files nor one oversized task results.
    """
    spark = df.sparkSession
    now = snapshots.latest(spark, path)
    folders = dict(now.folders)
    if days is not None:
        touched = {_folder(grain, _first_day(d, grain)) for d in days} & set(folders)
        df = df.filter(F.col("sale_date").isin(list(days)))
        if touched and grain != "day":
            others = snapshots.read(spark, path, _with_period(df.schema), now, sorted(touched))
            df = df.unionByName(others.filter(~F.col("sale_date").isin(list(days))).select(*df.columns))
        for folder in touched:
            del folders[folder]
    folders |= _staged(df, path, grain, now.number + 1)
    snapshots.publish(spark, path, snapshots.Snapshot(now.number + 1, folders))
    snapshots.tidy(spark, path)


def _with_period(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("sale_period", T.DateType())])


def _first_day(day: dt.date, grain: str) -> dt.date:
    if grain == "year":
        return day.replace(month=1, day=1)
    return day.replace(day=1) if grain == "month" else day


def drop_before(spark: SparkSession, path: str, ddl: str, day: dt.date, grain: str = "day") -> None:
    """Remove the stored days before ``day``: whole periods by their folders, without reading them; of
    the period that holds ``day``, the later days are written anew. All of it takes effect at once.
    """
    now, holding = snapshots.latest(spark, path), _first_day(day, grain)
    folders = {f: v for f, v in now.folders.items() if f >= _folder(grain, holding)}
    partly = grain != "day" and holding < day and _folder(grain, holding) in folders
    if not partly and len(folders) == len(now.folders):
        return
    if partly:
        del folders[_folder(grain, holding)]
        stored = snapshots.read(spark, path, _with_period(schemas.struct(ddl)), now, [_folder(grain, holding)])
        kept = stored.filter(F.col("sale_date") >= F.lit(day)).drop("sale_period")
        folders |= _staged(kept, path, grain, now.number + 1)
    snapshots.publish(spark, path, snapshots.Snapshot(now.number + 1, folders))
    snapshots.tidy(spark, path)


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return snapshots.read(spark, path, schemas.struct(ddl))


def append_staging(
    df: DataFrame, path: str, grain: str = "day", days: Sequence[dt.date] | None = None
) -> None:
    """Add extracted sales; extracting a period again replaces it instead of doubling it."""
    write_periods(df, path, grain, days)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.STAGING_SALES)


def write_metrics(
    df: DataFrame, path: str, grain: str = "day", days: Sequence[dt.date] | None = None
) -> None:
    """Store daily metrics, replacing the periods present or the days given."""
    write_periods(df, path, grain, days)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.DAILY_METRICS)


def archive_metrics(df: DataFrame, path: str) -> None:
    """Full backup copy of the metrics."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A backup copy of the metrics."""
    return spark.read.schema(schemas.struct(schemas.DAILY_METRICS)).parquet(path)
