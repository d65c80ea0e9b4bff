import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import cohort_bitmaps, retention
from tidemark.sources import snapshots


def _activity(spark, seed, n=3000):
    draw = random.Random(seed)
    signup = {u: dt.datetime(2024, 1, draw.randint(1, 9), 3) for u in [*range(300), 40_000, 70_001]}
    rows = [(u, signup[u], dt.datetime(2024, 1, draw.randint(1, 28), draw.randint(0, 23))) for u in draw.choices(list(signup), k=n)]
    rows += [(None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)), (5, None, dt.datetime(2024, 1, 1)), (5, signup[5], None)]
    return spark.createDataFrame(rows, "user_id bigint, signup_time timestamp, activity_time timestamp")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_kept_cells_equal_the_full_count(spark, out):
    activity = _activity(spark, 1).cache()
    day = F.dayofmonth("activity_time")
    parts = [activity.filter(day.between(a, b)) for a, b in ((1, 10), (8, 20), (21, 28), (5, 6))]
    for part in [*parts, activity.limit(0)]:
        cohort_bitmaps.add(part, out)
    whole = activity.dropna()
    kept = cohort_bitmaps.kept(spark, out)
    assert _rows(cohort_bitmaps.cohort_retention(kept)) == _rows(retention.cohort_retention(whole)) != []
    assert _rows(cohort_bitmaps.cohort_sizes(kept)) == _rows(retention.cohort_sizes(whole))
    per_day = whole.groupBy(F.to_date("activity_time")).agg(F.count_distinct("user_id"))
    assert _rows(cohort_bitmaps.active_users(kept)) == _rows(per_day)


def test_new_day_reads_and_rewrites_nothing_else(spark, out, monkeypatch):
    activity = _activity(spark, 2)
    cohort_bitmaps.add(activity.filter("activity_time < '2024-01-20'"), out)
    before = snapshots.latest(spark, out)
    read = []
    real = snapshots.read
    monkeypatch.setattr(snapshots, "read", lambda *a, **k: read.append(a) or real(*a, **k))
    days = cohort_bitmaps.add(activity.filter("to_date(activity_time) = '2024-01-20'"), out)
    after = snapshots.latest(spark, out)
    assert days == [dt.date(2024, 1, 20)] and read == []
    assert {f: v for f, v in after.folders.items() if f in before.folders} == before.folders
    assert set(after.folders) - set(before.folders) == {"activity_date=2024-01-20"}
