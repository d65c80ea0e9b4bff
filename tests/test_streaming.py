"""Streams over replay directories: modes, late data, restart, repeats, several queries."""

import datetime as dt
import json
from pathlib import Path
from unittest import mock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes as ch
from tidemark.operators import insight, metrics, parse
from tidemark.plans import monitor
from tidemark.session import ROCKSDB_PROVIDER, scratch_dir
from tidemark.sources import feeds, kafka, replay
from tidemark.streaming import runner, sinks

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def arrive(spark, path, timed_ops, topic="shop.sales.orders", table="orders"):
    data = [
        (
            None,
            json.dumps({"op": op, "source": {"table": table}}).encode(),
            topic,
            0,
            n,
            dt.datetime(2024, 1, 1, 0, *at),
            0,
        )
        for n, (at, op) in enumerate(timed_ops)
    ]
    replay.write_records(spark.createDataFrame(data, schemas.struct(schemas.RECORD)), path)


# Three micro-batches of (minute, second) and operation; the first row of the last
# one is older than the watermark reached before it.
BATCHES = [
    [((0, 10), "c"), ((5, 0), "c")],
    [((5, 30), "u")],
    [((0, 20), "c"), ((4, 30), "c")],
]


def counted(df):
    return rows(df.select(F.date_format("window_start", "mm"), "operation", "change_count"))


def run_late(spark, out, mode):
    seen = {}

    def collect(batch, batch_id):
        found = counted(batch)
        if found:
            seen[len(seen)] = found

    for batch in BATCHES:
        arrive(spark, f"{out}/feed", batch)
        ops = parse.topic_ops(replay.replay_stream(spark, f"{out}/feed"))
        stats = metrics.op_stats(ops, ordered=mode == "complete")
        runner.drain(runner.run_stream(stats, collect, f"{out}/cp", mode=mode))
    return seen


def test_late_rows_are_dropped_in_update_mode(spark, out):
    assert list(run_late(spark, out, "update").values()) == [
        [("00", "c", 1), ("05", "c", 1)],
        [("05", "u", 1)],
        [("04", "c", 1)],
    ]


def test_append_mode_emits_closed_windows_once(spark, out):
    emitted = [r for batch in run_late(spark, out, "append").values() for r in batch]
    assert ("00", "c", 1) in emitted
    assert len(emitted) == len(set(emitted))
    assert ("00", "c", 2) not in emitted


def test_complete_mode_counts_late_rows(spark, out):
    last = list(run_late(spark, out, "complete").values())[-1]
    assert last == [("00", "c", 2), ("04", "c", 1), ("05", "c", 1), ("05", "u", 1)]


def test_update_mode_result_is_the_last_count_per_window(spark, out):
    for at in (5, 10):
        arrive(spark, f"{out}/feed", [((1, at), "u"), ((1, at + 1), "c")])
        stream = replay.replay_stream(spark, f"{out}/feed")
        runner.drain(monitor.watch_metrics(stream, f"{out}/m", f"{out}/cp"))
    got = monitor.current_metrics(spark, f"{out}/m")
    assert counted(got) == [("01", "c", 2), ("01", "u", 2)]


def test_state_is_sized_for_the_query_alone(spark, out):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    arrive(spark, f"{out}/feed", [((1, 1), "u")])
    stream = replay.replay_stream(spark, f"{out}/feed")
    runner.drain(monitor.watch_metrics(stream, f"{out}/m", f"{out}/cp", state_partitions=6))
    state = [p for p in Path(f"{out}/cp/state/0").iterdir() if p.name.isdigit()]
    assert len(state) == 6 != int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_restart_neither_loses_nor_repeats(spark, out):
    for n in range(3):
        arrive(spark, f"{out}/feed", [((n, s), "u") for s in range(10)])
        stream = replay.replay_stream(spark, f"{out}/feed", max_files=1)
        ops = parse.topic_ops(stream).select("timestamp")
        runner.drain(runner.run_stream(ops, sinks.batch_table(f"{out}/t"), f"{out}/cp"))
    got = sinks.read_batches(spark, f"{out}/t", "timestamp timestamp")
    assert got.count() == 30 and got.select("timestamp").distinct().count() == 30


def test_failed_batch_is_done_again_without_repeats(spark, out):
    arrive(spark, f"{out}/feed", [((1, s), "u") for s in range(10)])
    write = sinks.batch_table(f"{out}/t")

    def fails_after_writing(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost after the write")

    def start(fn):
        ops = parse.topic_ops(replay.replay_stream(spark, f"{out}/feed")).select("operation")
        return runner.run_stream(ops, fn, f"{out}/cp")

    with pytest.raises(Exception, match="lost after the write"):
        runner.drain(start(fails_after_writing))
    runner.drain(start(write))
    assert sinks.read_batches(spark, f"{out}/t", "operation string").count() == 10


def test_another_checkpoint_on_an_output_is_refused(spark, out):
    def run(checkpoint):
        ops = parse.topic_ops(replay.replay_stream(spark, f"{out}/feed")).select("operation")
        runner.drain(runner.run_stream(ops, sinks.batch_table(f"{out}/t"), checkpoint))

    arrive(spark, f"{out}/feed", [((1, s), "u") for s in range(10)])
    run(f"{out}/cp")
    arrive(spark, f"{out}/feed", [((2, s), "u") for s in range(5)])
    with pytest.raises(Exception, match="holds results of query"):
        run(f"{out}/other")
    assert sinks.read_batches(spark, f"{out}/t", "operation string").count() == 10
    run(f"{out}/cp")
    assert sinks.read_batches(spark, f"{out}/t", "operation string").count() == 15


def test_folding_batches_keeps_every_row(spark, out):
    def run():
        ops = parse.topic_ops(replay.replay_stream(spark, f"{out}/feed")).select("timestamp")
        runner.drain(runner.run_stream(ops, sinks.batch_table(f"{out}/t"), f"{out}/cp"))

    ddl = "timestamp timestamp"
    for n in range(5):
        arrive(spark, f"{out}/feed", [((n, s), "u") for s in range(10)])
        run()
        before = rows(sinks.read_batches(spark, f"{out}/t", ddl))
        if n % 2:
            assert sinks.fold_batches(spark, f"{out}/t", ddl) == n - 1
            assert rows(sinks.read_batches(spark, f"{out}/t", ddl)) == before
    assert len(before) == 50 and len(list(Path(f"{out}/t").glob("batch_id=*"))) == 2


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_stream_equals_batch(spark, out, fmt):
    part = spark.read.parquet(f"{SF_DIR}/part.parquet")
    replay.write_records(feeds.product_feed(part), f"{out}/feed", fmt)
    stream = replay.replay_stream(spark, f"{out}/feed", fmt=fmt)
    runner.drain(monitor.watch_products(stream, f"{out}/p", f"{out}/cp"))
    history = parse.changes(replay.replay_history(spark, f"{out}/feed", fmt=fmt), "products")
    for name, ddl, fn in (
        ("price_changes", monitor.PRICE_CHANGES, ch.price_changes),
        ("stock_changes", monitor.STOCK_CHANGES, ch.stock_changes),
    ):
        written = sinks.read_batches(spark, f"{out}/p/{name}", ddl).drop("batch_id")
        assert rows(written) == rows(fn(history)) != []


def test_customer_program_writes_every_result(spark, out):
    customer = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    replay.write_records(feeds.customer_feed(customer), f"{out}/feed")
    stream = replay.replay_stream(spark, f"{out}/feed")
    runner.drain(monitor.watch_customers(stream, f"{out}/c", f"{out}/cp"))
    parsed = parse.changes(replay.replay_history(spark, f"{out}/feed"), "customers")
    volume = sinks.read_batches(spark, f"{out}/c/volume", monitor.VOLUME)
    assert volume.agg(F.sum("change_count")).first()[0] == customer.count()
    counts = sinks.read_batches(spark, f"{out}/c/op_counts", monitor.OP_COUNTS).drop("batch_id")
    assert rows(counts) == rows(ch.op_counts(parsed))
    for name in ("inserted", "deleted"):
        got = sinks.read_batches(spark, f"{out}/c/{name}", monitor.INSERTED).drop("batch_id")
        assert rows(got) == rows(getattr(ch, f"{name}_rows")(parsed)) != []


def test_topics_are_selected(spark, out):
    arrive(spark, f"{out}/feed", [((0, 1), "c")], topic="a")
    arrive(spark, f"{out}/feed", [((0, 1), "c")] * 2, topic="b")
    arrive(spark, f"{out}/feed", [((0, 1), "c")] * 3, topic="c")
    assert replay.replay_history(spark, f"{out}/feed").count() == 6
    assert replay.replay_history(spark, f"{out}/feed", "a, c").count() == 4
    assert replay.replay_history(spark, f"{out}/feed", ["b"]).count() == 2


def test_running_queries_are_awaited_and_stopped(spark, out):
    arrive(spark, f"{out}/feed", [((0, 1), "c")], topic="shop.sales.customers", table="customers")
    asked = []

    def subscribe(topics):
        asked.append(topics)
        return replay.replay_stream(spark, f"{out}/feed", topics)

    started = monitor.run_all(subscribe, f"{out}/o", f"{out}/cp", every="1 second")
    own = ["shop.sales.customers"], ["shop.sales.products"]
    assert asked == [*own, ["shop.sales.customers", "shop.sales.products", "shop.sales.orders"]]
    assert {q.name for q in started} == {"customers", "products", "metrics"}
    runner.await_first(spark, timeout=1)
    for query in started:
        query.processAllAvailable()
    assert set(runner.stop_all(spark)) == {"customers", "products", "metrics"}
    assert spark.streams.active == []
    got = monitor.current_metrics(spark, f"{out}/o/metrics")
    assert rows(got.select("table_name", "operation", "change_count")) == [("customers", "c", 1)]


def test_change_log_keeps_row_images_as_text(spark, out):
    value = {"op": "u", "source": {"table": "t", "ts_ms": 0}, "before": {"id": 1}, "after": {"id": 2}}
    data = [(None, json.dumps(value).encode(), "x", 0, 5, dt.datetime(2024, 1, 1), 0)]
    replay.write_records(
        spark.createDataFrame(data, schemas.struct(schemas.RECORD)), f"{out}/feed"
    )
    for _ in range(2):
        stream = replay.replay_stream(spark, f"{out}/feed")
        runner.drain(monitor.keep_change_log(stream, f"{out}/log", f"{out}/cp"))
    (row,) = monitor.change_log(spark, f"{out}/log").collect()
    assert (row["before_data"], row["after_data"]) == ('{"id":1}', '{"id":2}')
    assert (row["table_name"], row["event_date"]) == ("t", dt.date(1970, 1, 1))


def test_orders_are_joined_adaptively_per_batch(spark, out):
    image = {"id": 1, "customer_id": 7, "total_amount": 1.5, "status": "P"}
    value = {"op": "c", "source": {"table": "orders"}, "after": image}
    data = [(None, json.dumps(value).encode(), "x", 0, n, dt.datetime(2024, 1, 1), 0) for n in (1, 2)]
    replay.write_records(spark.createDataFrame(data, schemas.struct(schemas.RECORD)), f"{out}/feed")
    customers = spark.createDataFrame(
        [(7, "A", "B", "e")], "id int, first_name string, last_name string, email string"
    )
    plans = []

    def planned(batch, batch_id):
        joined = insight.enrich_changes(batch, customers)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())

    stream = replay.replay_stream(spark, f"{out}/feed")
    parsed = parse.changes(stream, "orders", ["id", "customer_id", "total_amount", "status"])
    runner.drain(runner.run_stream(parsed, planned, f"{out}/cp1"))
    assert plans and all("AdaptiveSparkPlan" in plan for plan in plans)
    runner.drain(monitor.watch_orders(stream, customers, f"{out}/o", f"{out}/cp2"))
    got = sinks.read_batches(spark, f"{out}/o/enriched", monitor.ENRICHED)
    assert rows(got.select("order_id", "email")) == [(1, "e"), (1, "e")]


def test_state_in_rocksdb(spark, out):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        for _ in range(2):
            arrive(spark, f"{out}/feed", [((1, 1), "u")])
            stream = replay.replay_stream(spark, f"{out}/feed")
            runner.drain(monitor.watch_stats(stream, f"{out}/m", f"{out}/cp"))
    finally:
        spark.conf.unset(key)
    stats = monitor.current_stats(spark, f"{out}/m")
    assert counted(stats) == [("01", "u", 2)]


def test_console_prints_a_batch(spark, capsys):
    sinks.console(2)(spark.range(5), 7)
    printed = capsys.readouterr().out
    assert "batch 7" in printed and "only showing top 2 rows" in printed


def test_kafka_settings_reach_the_source():
    spark = mock.MagicMock()
    kafka.change_stream(spark, "h:1", ["a", "b"], options={"kafka.security.protocol": "PLAINTEXT"})
    reader = spark.readStream.format
    reader.assert_called_with("kafka")
    reader.return_value.options.assert_called_with(
        **{
            "kafka.bootstrap.servers": "h:1",
            "subscribe": "a,b",
            "kafka.security.protocol": "PLAINTEXT",
        }
    )
    reader.return_value.options.return_value.option.assert_called_with("startingOffsets", "latest")


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka.change_history(spark, "h:1", "a")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (scratch_dir(spark, "x") for _ in range(2))
    assert first.startswith(shared) and first != second
