import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import insight
from tidemark.sources import snapshots, state_table


def _orders(spark, seed=1, n=600):
    draw = random.Random(seed)
    rows = [(i, draw.randint(1, 20), 1_000_000 + draw.randint(-300, 300) / 100) for i in range(n)]
    rows += [(n, None, 5.0), (n + 1, 3, None), (n + 2, 99, 7.0), (n + 3, 3, 1_000_100.0)]
    df = spark.createDataFrame(rows, "id bigint, customer_id bigint, total_amount double")
    return df.withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)")).cache()


def _values(df):
    return {r.row_key: (r.order_count, r.mean_amount, r.m2) for r in df.collect()}


def test_moments_merge_in_any_order(spark):
    """Large means with small deviations, where sums of squares would lose all digits."""
    orders = _orders(spark)
    whole = _values(insight.order_moments(orders))
    parts = [insight.order_moments(orders.filter(F.col("id") % 3 == i)) for i in range(3)]
    for order in itertools.permutations(parts):
        got = _values(insight.merged_moments(insight.merged_moments(order[0], order[1]), order[2]))
        assert got.keys() == whole.keys()
        for k, (n, mean, m2) in got.items():
            assert n == whole[k][0] and mean == pytest.approx(whole[k][1], rel=1e-12)
            assert m2 == pytest.approx(whole[k][2], rel=1e-9, abs=1e-9)


def test_a_batch_counts_once(spark, out):
    orders = _orders(spark)
    schema = schemas.struct(insight.MOMENTS)
    assert state_table.read(spark, out, schema).count() == 0
    for batch in (0, 0, 1, 0, 1, 2):
        part = orders.filter(F.col("id") % 3 == batch)
        state_table.update(insight.order_moments(part), out, insight.merged_moments, 4, batch)
    assert snapshots.latest(spark, out).upto == 2
    got = _values(state_table.read(spark, out, schema))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in _values(insight.order_moments(orders)).items()}
    found = insight.anomalies_from_moments(orders, state_table.read(spark, out, schema))
    want = insight.transaction_anomalies(orders)
    assert sorted(r.order_id for r in found.collect()) == sorted(r.order_id for r in want.collect()) != []
