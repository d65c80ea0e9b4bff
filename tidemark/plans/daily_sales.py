"""The daily sales run: stage, validate, measure, report, then clean up and archive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import quality, sales
from tidemark.sources import tables


class ExtractInvalid(ValueError):
    """Extracted sales failed validation."""


def run_day(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    as_of: dt.date | str,
    backfill: bool = False,
    grain: str = "day",
    keep_days: int = 7,
    minimum: int = 0,
) -> DataFrame:
    """Run every step for ``as_of`` (with ``backfill``: for all days of ``raw``) below ``base`` and
    return the report. A repeated run replaces what the first one wrote, and a day that has lost all
    its sales is emptied. A run for one day keeps all others, whatever the ``grain``.

    The gate stops the run before anything is measured: validation must find no fault, and at least
    ``minimum`` sales must have been extracted. Undated sales belong to no day; they stop nothing, and
    ``quality.validate_extract`` reports them. Last, staging keeps ``keep_days`` days before ``as_of``.
    """
    today = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    day, days = (None, None) if backfill else (today, [today])
    staging_path, metrics_path = f"{base}/staging_sales", f"{base}/daily_metrics"

    tables.append_staging(sales.extract_daily_sales(raw, day), staging_path, grain, days)
    staging = tables.read_staging(spark, staging_path)

    found = quality.validate_extract(staging, raw, day).filter("check_name <> 'undated rows'")
    failed = found.filter("violations > 0").collect()
    if failed:
        raise ExtractInvalid(", ".join(f"{r['check_name']}: {r['violations']}" for r in failed))
    of_run = staging if backfill else staging.filter(F.col("sale_date") == F.lit(today))
    quality.enforce(quality.row_count_gate(of_run.agg(F.count(F.lit(1)).alias("total_records")), minimum))

    tables.write_metrics(sales.daily_metrics(staging, day), metrics_path, grain, days)
    metrics = tables.read_metrics(spark, metrics_path)

    cutoff = today - dt.timedelta(days=keep_days)
    tables.drop_before(spark, staging_path, schemas.STAGING_SALES, cutoff, grain)
    tables.archive_metrics(metrics, f"{base}/archive/{today}")
    return sales.daily_report(metrics)
