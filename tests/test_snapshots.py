"""Tables that change by snapshots: whatever step a job ends at, readers see all of it or nothing."""

import datetime as dt
import glob
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import sales
from tidemark.plans import monitor
from tidemark.sources import replay, snapshots, tables
from tidemark.streaming import runner, sinks

STEPS = ["stage", "publish", "tidy"]


class Ended(RuntimeError):
    pass


def _ends(monkeypatch, step, after):
    """The job ends before or just after a step."""
    real = getattr(snapshots, step)

    def run(*args, **kwargs):
        out = real(*args, **kwargs) if after else None
        raise Ended(f"{step}: {out}")

    monkeypatch.setattr(snapshots, step, run)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _sales(spark, days, price):
    data = [(c, 1, 1, price, dt.datetime(2024, 1, d, 12)) for d in days for c in (1, 2)]
    raw = spark.createDataFrame(data, schemas.struct("customer_id bigint, product_id bigint, quantity int, price int, created_at timestamp"))
    return sales.extract_daily_sales(raw)


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_write_of_days_is_all_or_nothing(spark, out, monkeypatch, step, after, grain):
    tables.append_staging(_sales(spark, [1, 2, 3], 5), out, grain)
    before = _rows(tables.read_staging(spark, out))
    wanted = sorted([*(r for r in before if r[5].day == 1), *_rows(_sales(spark, [2, 3], 7))])
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    with monkeypatch.context() as patched, pytest.raises(Ended):
        _ends(patched, step, after)
        tables.append_staging(_sales(spark, [2, 3], 7), out, grain, days)
    published = step == "tidy" or (step == "publish" and after)
    assert _rows(tables.read_staging(spark, out)) == (wanted if published else before)
    tables.append_staging(_sales(spark, [2, 3], 7), out, grain, days)
    assert _rows(tables.read_staging(spark, out)) == wanted


@pytest.mark.parametrize("step", STEPS)
def test_cleanup_is_all_or_nothing(spark, out, monkeypatch, step):
    tables.append_staging(_sales(spark, [1, 2, 3], 5), out, "month")
    before = _rows(tables.read_staging(spark, out))
    drop = lambda: tables.drop_before(spark, out, schemas.STAGING_SALES, dt.date(2024, 1, 3), "month")
    with monkeypatch.context() as patched, pytest.raises(Ended):
        _ends(patched, step, False)
        drop()
    assert _rows(tables.read_staging(spark, out)) in (before, [r for r in before if r[5].day == 3])
    drop()
    assert _rows(tables.read_staging(spark, out)) == [r for r in before if r[5].day == 3]


def test_reader_keeps_the_snapshot_it_began_on(spark, out):
    tables.append_staging(_sales(spark, [1, 2], 5), out)
    reader = tables.read_staging(spark, out)
    before = _rows(reader)
    tables.append_staging(_sales(spark, [1, 2], 7), out)
    assert _rows(reader) == before != _rows(tables.read_staging(spark, out))


def test_useless_folders_go(spark, out):
    for price in (1, 2, 3, 4):
        tables.append_staging(_sales(spark, [1, 2], price), out)
    assert sorted(p.name for p in Path(out).glob("version=*")) == ["version=3", "version=4"]
    tables.append_staging(_sales(spark, [2], 9), out, days=[dt.date(2024, 1, 2)])
    tables.append_staging(_sales(spark, [2], 8), out, days=[dt.date(2024, 1, 2)])
    assert sorted(p.name for p in Path(out).glob("version=4/sale_date=*")) == ["sale_date=2024-01-01"]
    assert tables.read_staging(spark, out).count() == 4


def test_second_writer_of_a_number_is_refused(spark, out):
    snapshots.publish(spark, out, snapshots.Snapshot(1, {}))
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, out, snapshots.Snapshot(1, {"a=1": [1]}))
    assert snapshots.latest(spark, out) == snapshots.Snapshot(1, {})


def _batches(spark, path, numbers, rows=10):
    for n in numbers:
        spark.range(n * rows, (n + 1) * rows).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={n}")


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", [*STEPS, "delete"])
def test_folding_loses_nothing_at_any_end(spark, out, monkeypatch, step, after):
    path, ddl = f"{out}/t", "id bigint"
    _batches(spark, path, range(3))
    sinks.fold_batches(spark, path, ddl)
    _batches(spark, path, range(3, 5))
    everything = _rows(sinks.read_batches(spark, path, ddl))
    with monkeypatch.context() as patched, pytest.raises(Ended):
        _ends(patched, step, after)
        sinks.fold_batches(spark, path, ddl)
    assert _rows(sinks.read_batches(spark, path, ddl)) == everything
    assert sinks.fold_batches(spark, path, ddl) == 3
    assert _rows(sinks.read_batches(spark, path, ddl)) == everything and len(everything) == 50
    assert sinks.fold_batches(spark, path, ddl) == 3
    assert _rows(sinks.read_batches(spark, path, ddl)) == everything


def test_batches_put_back_after_folding_change_nothing(spark, out):
    path, ddl = f"{out}/t", "id bigint"
    _batches(spark, path, range(4))
    everything = _rows(sinks.read_batches(spark, path, ddl))
    assert sinks.fold_batches(spark, path, ddl) == 2
    _batches(spark, path, range(3))
    for _ in range(2):
        assert sinks.fold_batches(spark, path, ddl) == 2
        assert _rows(sinks.read_batches(spark, path, ddl)) == everything
    assert len(everything) == 40


def test_versions_of_a_folded_table_stay_few(spark, out):
    path, ddl = f"{out}/t", "id bigint"
    for n in range(12):
        _batches(spark, path, [n], 2)
        sinks.fold_batches(spark, path, ddl)
        assert len(snapshots.latest(spark, path + "__folded").folders.get("", [])) < sinks._RUNS
    assert _rows(sinks.read_batches(spark, path, ddl).select("id")) == [(i,) for i in range(24)]


def _log(spark, out, batch, n=400):
    """A log batch with one change of each of ``n`` rows of two tables."""
    value = lambda t, i: json.dumps({"op": "u", "source": {"table": t, "ts_ms": batch * 1000}, "after": {"id": i}})
    data = [(None, value(t, i).encode(), t, 0, i, dt.datetime(2024, 1, 1), 0) for t in ("a", "b") for i in range(n)]
    replay.write_records(spark.createDataFrame(data, schemas.struct(schemas.RECORD)), f"{out}/feed")
    stream = replay.replay_stream(spark, f"{out}/feed")
    runner.drain(monitor.keep_change_log(stream, f"{out}/log", f"{out}/cp"))


def _rows_scanned(df):
    """Rows that the scans of a finished plan have read."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    found, waiting = 0, [plan]
    while waiting:
        node = waiting.pop()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
        if "FileSourceScan" in node.getClass().getName():
            found += node.metrics().apply("numOutputRows").value()
    return found


def test_change_log_is_compacted_by_table_and_key(spark, out):
    for batch in range(5):
        _log(spark, out, batch)
    before = _rows(monitor.change_log(spark, f"{out}/log"))
    assert len(before) == 5 * 800
    assert monitor.compact_change_log(spark, f"{out}/log") == 3
    assert _rows(monitor.change_log(spark, f"{out}/log")) == before
    assert len(glob.glob(f"{out}/log/*/*/batch_id=*")) == 2
    (folded,) = {tuple(snapshots.latest(spark, f"{out}/log__folded").folders)}
    assert sorted(folded) == [f"table_name={t}/event_date=1970-01-01" for t in "ab"]

    conf = {"spark.sql.files.maxRecordsPerFile": "200"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        _log(spark, out, 5)
        assert monitor.compact_change_log(spark, f"{out}/log") == 4
    finally:
        for key in conf:
            spark.conf.unset(key)
    one = monitor.change_log(spark, f"{out}/log").filter((F.col("row_key") == 7) & (F.col("table_name") == "a"))
    assert len(one.collect()) == 6


def test_files_read_for_one_key_fall(spark, out):
    """Statistics of clustered files keep a reader of one key from most rows."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        for batch in range(3):
            _log(spark, out, batch, 1000)
        of_key = lambda: monitor.change_log(spark, f"{out}/log").filter("row_key = 7 AND table_name = 'a' AND batch_id < 2")
        scattered = spark.read.parquet(f"{out}/log").repartition(8).sortWithinPartitions(F.hash("offset"))
        scattered.write.parquet(f"{out}/scattered")
        loose = spark.read.parquet(f"{out}/scattered").filter("row_key = 7 AND table_name = 'a' AND batch_id < 2")
        assert len(loose.collect()) == 2
        assert monitor.compact_change_log(spark, f"{out}/log") == 1
        near = of_key()
        assert len(near.collect()) == 2
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert _rows_scanned(near) <= 200 and 2 * _rows_scanned(near) <= _rows_scanned(loose)


def test_batch_is_seen_when_all_of_it_is_written(spark, out):
    """Of a batch that ended within its write, over several folders, readers see nothing; a repeat completes it."""
    write = sinks.partitioned_table(f"{out}/log", ["part"])
    batch = lambda n: spark.range(n * 10, n * 10 + 10).withColumn("part", F.col("id") % 3)
    write(batch(0), 0)
    ddl = "id bigint, part bigint"
    before = _rows(sinks.read_batches(spark, f"{out}/log", ddl))
    half = batch(1).filter("part = 1").withColumn("batch_id", F.lit(1))
    half.write.mode("append").partitionBy("part", "batch_id").parquet(f"{out}/log")
    assert _rows(sinks.read_batches(spark, f"{out}/log", ddl)) == before
    write(batch(1), 1)
    assert sinks.read_batches(spark, f"{out}/log", ddl).count() == 20
    write(batch(1), 1)
    write(batch(0), 0)
    assert sinks.read_batches(spark, f"{out}/log", ddl).count() == 20
    assert snapshots.names(spark, f"{out}/log/_finished") == ["1"]
