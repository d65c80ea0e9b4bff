"""Two streams joined: equal to the join of the tables, with state that leaves."""

import datetime as dt
import json

from tidemark import schemas
from tidemark.plans import monitor, queries
from tidemark.sources import replay
from tidemark.streaming import progress, runner, sinks

HOUR = 3_600_000


def _message(table, at, image):
    value = json.dumps({"op": "c", "source": {"table": table, "ts_ms": at}, "after": image}).encode()
    return (None, value, f"shop.sales.{table}", 0, 0, dt.datetime(2024, 1, 1), 0)


def _order(i, hour):
    return _message("orders", hour * HOUR, {"id": i, "customer_id": 1, "total_amount": 1.5, "status": "P"})


def _item(i, order, hour):
    return _message("order_items", hour * HOUR, {"id": i, "order_id": order, "product_id": 9, "quantity": 1, "unit_price": 2.5})


def _run(spark, out, rows):
    replay.write_records(spark.createDataFrame(rows, schemas.struct(schemas.RECORD)), f"{out}/feed")
    stream = replay.replay_stream(spark, f"{out}/feed")
    query = monitor.watch_order_lines(stream, f"{out}/o", f"{out}/cp", late="2 hours", within="3 hours", state_partitions=2)
    runner.drain(query)


def _lines(spark, out):
    found = sinks.read_batches(spark, f"{out}/o", monitor.ORDER_LINES)
    return sorted(((r.order_id, r.item_id) for r in found.collect()), key=repr)


def test_matches_unmatched_and_late_rows(spark, out):
    with progress.recording(spark, f"{out}/p"):
        _run(spark, out, [_order(1, 10), _order(2, 10), _item(11, 1, 11), _item(12, 1, 14)])
        assert _lines(spark, out) == [(1, 11)]
        _run(spark, out, [_order(3, 20), _item(13, 3, 19), _item(14, 3, 20), _item(15, 2, 12)])
        # Item 15 came 2 hours behind item 12 at hour 14, the bound allowed, and still meets its order.
        assert set(_lines(spark, out)) >= {(1, 11), (2, 15), (3, 14)}
        _run(spark, out, [_item(16, 1, 11), _order(4, 30), _item(17, 4, 30)])
        _run(spark, out, [_order(5, 40), _item(18, 5, 41)])
    lines = _lines(spark, out)
    assert lines == sorted([(1, 11), (2, 15), (3, 14), (4, 17), (5, 18)], key=repr)
    found = progress.read(spark, f"{out}/p").orderBy("batch_id").collect()
    assert sum(r.input_rows for r in found) > 0 and max(r.late_rows for r in found) >= 1
    assert found[-1].state_rows <= 4


def test_order_without_items_comes_once(spark, out):
    _run(spark, out, [_order(1, 10), _order(2, 11), _item(11, 2, 12)])
    for hour in (30, 50, 70):
        _run(spark, out, [_order(hour, hour), _item(hour, hour, hour)])
    assert _lines(spark, out).count((1, None)) == 1
    assert (2, None) not in _lines(spark, out)


def test_more_arrivals_give_the_same_lines(spark, monkeypatch):
    """A long history arrives in more batches, so the state holds no more; the lines are the same."""
    made, write = [], replay.write_records
    monkeypatch.setattr(replay, "write_records", lambda records, path: (made.append(records), write(records, path)))
    stream = lambda: sorted(map(tuple, queries.order_lines_stream(spark, "/root/testdata/sf0.001").collect()), key=repr)
    want = stream()
    assert want and len(made) == 3
    # Either table of an arrival is dealt out before messages are made of its rows.
    assert made[0]._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    monkeypatch.setattr(queries, "ARRIVAL_ROWS", 1600)
    assert stream() == want
    assert len(made) == 3 + 5
