"""Values as of a row: equal to a search by hand, with keys of any size spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import skew
from tidemark.operators import insight
from tidemark.plans import queries

SF_DIR = "/root/testdata/sf0.001"
DDL = "k bigint, t bigint, side int, seq bigint, v struct<x:bigint>"


def _rows(seed, n=400, hot=0.6):
    draw = random.Random(seed)
    return [
        (None if draw.random() < 0.02 else 0 if draw.random() < hot else draw.randint(1, 9), draw.randint(0, 60), 0, i, (i if draw.random() < 0.9 else None,))
        if draw.random() < 0.3
        else (0 if draw.random() < hot else draw.randint(1, 9), draw.randint(0, 60), 1, i, None)
        for i in range(n)
    ]


def _by_hand(rows):
    out = []
    for k, t, side, seq, v in rows:
        before = [r for r in rows if r[0] == k and r[4] is not None and (r[1], r[2], r[3]) <= (t, side, seq)]
        out.append((k, t, side, seq, max(before, key=lambda r: r[1:4])[4] if before else None))
    return sorted(out, key=repr)


def _plain(df):
    return sorted(((r.k, r.t, r.side, r.seq, None if r.v is None else (r.v.x,)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("key_rows,slices", [(100_000, 200), (5, 200), (20, 3), (50, 7)])
def test_last_before(spark, key_rows, slices):
    rows = _rows(key_rows)
    df = spark.createDataFrame(rows, DDL)
    got = skew.last_before(df, "k", ["t", "side", "seq"], "v", key_rows, slices)
    assert got.columns == df.columns and _plain(got) == _by_hand(rows)


def test_hot_key_is_cut(spark):
    """A key of most rows is in many windows, none of which holds many more rows than asked for."""
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.lit(1).alias("side"), F.col("id").alias("seq"), F.when(F.col("id") == 3, F.struct("id")).alias("v"))
    got = skew.last_before(df, "k", ["t", "side", "seq"], "v", 200)
    assert got.filter("v.id = 3").count() == 3997
    windows = got._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" in windows and "percentile_approx" in windows


def test_no_join_of_ranges(spark):
    columns = ["id", "customer_id", "total_amount", "status"]
    orders = queries.parse.changes(queries._order_records(spark, SF_DIR), "orders", columns)
    got = insight.enrich_changes_as_of(orders, queries._history_changes(spark, SF_DIR))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == orders.count()


def test_unknown_and_deleted_customers(spark):
    image = "struct<id:bigint,customer_id:bigint,total_amount:decimal(10,2),status:string>"
    person = "struct<id:bigint,first_name:string,last_name:string,email:string>"
    order = lambda o, c, t, n: ("c", t, n, None, (o, c, None, "P"))
    orders = spark.createDataFrame(
        [order(1, 7, 4, 1), order(2, 7, 5, 2), order(3, 7, 9, 3), order(4, 8, 9, 4), order(5, None, 9, 5), order(6, 7, 8, 6)],
        f"operation string, source_timestamp bigint, offset bigint, before_data {image}, after_data {image}",
    )
    changes = spark.createDataFrame(
        [("c", 5, 1, None, (7, "A", "B", "e")), ("d", 9, 2, (7, "A", "B", "e"), None), ("u", 8, 3, (7, "A", "B", "e"), (7, "A", None, "f"))],
        f"operation string, source_timestamp bigint, offset bigint, before_data {person}, after_data {person}",
    )
    got = {r.order_id: (r.first_name, r.email) for r in insight.enrich_changes_as_of(orders, changes).collect()}
    assert got == {1: (None, None), 2: ("A", "e"), 3: (None, None), 4: (None, None), 5: (None, None), 6: ("A", "f")}
