"""Every operator as a query over a folder of test tables.

Change operators see the tables as change messages (``sources.feeds``) and go through real JSON.
Streaming queries write their feed in time-ordered slices; after each slice the stream is started
on the same checkpoint, works off what is new, and ends. So every streaming query here also resumes
from its checkpoint, with state and watermark carried over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import changes as ch
from tidemark.operators import cohort_bitmaps, insight, kept_constraints, metrics, parse, quality, retention, sales, state, variants
from tidemark.plans import daily_sales, monitor
from tidemark.session import scratch_dir, stored
from tidemark.sources import feeds, replay, state_table, tables
from tidemark.streaming import progress, runner, sinks

Query = Callable[[SparkSession, str], DataFrame]
Start = Callable[[DataFrame, str, str], StreamingQuery | list[StreamingQuery]]

# The windowed counts of the test streams need little state.
STATE_PARTITIONS = 8

# Rows of both tables that arrive at once in the stream of order lines: what arrives is in its state until the next
# batch, so this bounds the state, however long the history.
ARRIVAL_ROWS = 16_000_000

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark = spark.newSession()
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- inputs ---------------------------------------------------------------------------------


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.table(spark, name, d)


def _spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by ``key`` over all cores. A table of a few million rows may be one small file, which a
    scan gives to a task or two; what is made of its rows costs far more than to move them.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _customer_records(spark: SparkSession, d: str) -> DataFrame:
    return feeds.customer_feed(_spread(_t(spark, d, "customer"), "c_custkey"))


def _product_records(spark: SparkSession, d: str) -> DataFrame:
    return feeds.product_feed(_spread(_t(spark, d, "part"), "p_partkey"))


def _order_records(spark: SparkSession, d: str) -> DataFrame:
    return feeds.order_feed(_spread(_t(spark, d, "orders"), "o_orderkey"))


def _all_records(spark: SparkSession, d: str) -> DataFrame:
    return (
        _customer_records(spark, d)
        .unionByName(_product_records(spark, d))
        .unionByName(_order_records(spark, d))
    )


def _customer_changes(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return parse.changes(_customer_records(spark, d), "customers", columns or None)


def _product_changes(spark: SparkSession, d: str) -> DataFrame:
    columns = ["id", "name", "price", "quantity_in_stock"]
    return parse.changes(_product_records(spark, d), "products", columns)


def _history_changes(spark: SparkSession, d: str) -> DataFrame:
    return parse.changes(feeds.customer_history_feed(_t(spark, d, "orders")), "customers")


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return feeds.raw_sales(_t(spark, d, "orders"), _t(spark, d, "lineitem"))


def _staging(spark: SparkSession, d: str) -> DataFrame:
    return sales.extract_daily_sales(_raw(spark, d))


def _last_order_day(spark: SparkSession, d: str):
    return _t(spark, d, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]


def _activity(spark: SparkSession, d: str) -> DataFrame:
    return feeds.user_activity(_t(spark, d, "events"))


def _stored(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    names = ("customer", "part", "orders", "lineitem", "supplier")
    return feeds.stored_tables({n: _t(spark, d, n) for n in names})


def _slices(df: DataFrame, column: str, n: int = 2) -> list[DataFrame]:
    """``df`` in ``n`` parts of ascending ``column``; rows without a value are in the first."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return [df, *[df.limit(0)] * (n - 1)]
    edges = [low + (high - low) * i / n for i in range(1, n)]
    if isinstance(low, int):
        edges = [int(e) for e in edges]
    value = F.col(column)
    parts = []
    for i in range(n):
        part = df
        if i > 0:
            part = part.filter(value >= F.lit(edges[i - 1]))
        if i < n - 1:
            below = value < F.lit(edges[i])
            part = part.filter(below | value.isNull() if i == 0 else below)
        parts.append(part)
    return parts


def _replayed(
    spark: SparkSession,
    label: str,
    arrivals: list[DataFrame],
    start: Start,
    topics: str | None = None,
    by_topic: bool = False,
) -> str:
    """Let records arrive slice by slice, run the stream after each, and return its output folder."""
    base = scratch_dir(spark, label)
    for records in arrivals:
        replay.write_records(records, f"{base}/feed")
        subscribe = partial(replay.replay_stream, spark, f"{base}/feed")
        records = subscribe if by_topic else subscribe(topics)
        started = start(records, f"{base}/out", f"{base}/checkpoint")
        for query in started if isinstance(started, list) else [started]:
            runner.drain(query)
    return f"{base}/out"


def _customer_arrivals(spark: SparkSession, d: str, n: int = 2) -> list[DataFrame]:
    return [feeds.customer_feed(_spread(p, "c_custkey")) for p in _slices(_t(spark, d, "customer"), "c_custkey", n)]


def _product_arrivals(spark: SparkSession, d: str) -> list[DataFrame]:
    return [feeds.product_feed(_spread(p, "p_partkey")) for p in _slices(_t(spark, d, "part"), "p_partkey")]


def _mixed_arrivals(spark: SparkSession, d: str) -> list[DataFrame]:
    """Orders first, since their times lie before those of the other two tables."""
    return [
        _order_records(spark, d),
        _customer_records(spark, d).unionByName(_product_records(spark, d)),
    ]


# ---- sources and sinks ----------------------------------------------------------------------


@_query
def change_stream(spark: SparkSession, d: str) -> DataFrame:
    def start(records, out, checkpoint):
        seen = parse.message_metadata(records).drop("avro_value")
        return runner.run_stream(seen, sinks.batch_table(out), checkpoint)

    out = _replayed(spark, "change-stream", _customer_arrivals(spark, d), start)
    ddl = "topic string, partition int, offset bigint, timestamp timestamp, message_key string"
    return sinks.read_batches(spark, out, ddl).drop("batch_id")


@_query
def multi_topic_stream(spark: SparkSession, d: str) -> DataFrame:
    def start(records, out, checkpoint):
        return runner.run_stream(records.select("topic"), sinks.batch_table(out), checkpoint)

    wanted = ",".join(feeds.topic_name(t) for t in ("customers", "orders"))
    out = _replayed(spark, "multi-topic", _mixed_arrivals(spark, d), start, wanted)
    seen = sinks.read_batches(spark, out, "topic string")
    return seen.groupBy("topic").agg(F.count(F.lit(1)).alias("message_count"))


@_query
def change_history(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "change-history")
    replay.write_records(_all_records(spark, d), path)
    history = replay.replay_history(spark, path)
    return history.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@_query
def table_scan(spark: SparkSession, d: str) -> DataFrame:
    orders = tables.table(spark, "orders", d)
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast("decimal(10,2)")).cast("decimal(20,2)").alias("total"),
    )


@_query
def run_stream(spark: SparkSession, d: str) -> DataFrame:
    """Several results written from one micro-batch."""

    def start(records, out, checkpoint):
        parsed = parse.changes(records, "products", ["id", "name", "price", "quantity_in_stock"])
        results = {"op_counts": ch.op_counts, "restock": insight.restock_alerts}
        return runner.run_stream(parsed, sinks.batch_tables(results, out), checkpoint)

    out = _replayed(spark, "run-stream", _product_arrivals(spark, d), start)
    counted = sinks.read_batches(spark, f"{out}/op_counts", monitor.OP_COUNTS)
    alerts = sinks.read_batches(spark, f"{out}/restock", monitor.STOCK_CHANGES).drop("batch_id")
    counts = counted.groupBy("operation").agg(F.sum("change_count").alias("change_count"))
    return _as_text({"op_counts": counts, "restock": alerts})


@_query
def append_staging(spark: SparkSession, d: str) -> DataFrame:
    """All sales by month, twice: the repeat replaces the months of the first run."""
    path = scratch_dir(spark, "staging")
    for _ in range(2):
        tables.append_staging(_staging(spark, d), path, "month")
    return tables.read_staging(spark, path)


@_query
def write_metrics(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "metrics")
    tables.write_metrics(sales.daily_metrics(_staging(spark, d)), path, "year")
    return tables.read_metrics(spark, path)


@_query
def archive_metrics(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "archive")
    tables.archive_metrics(sales.daily_metrics(_staging(spark, d)), path)
    return tables.read_archive(spark, path)


# ---- parsing --------------------------------------------------------------------------------


@_query
def parse_changes_customers(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse.parse_changes(_customer_records(spark, d), "customers")
    return parsed.select(
        "message_key",
        "timestamp",
        F.col("data.op").alias("op"),
        F.col("data.ts_ms").alias("ts_ms"),
        F.col("data.transaction").alias("transaction"),
        F.col("data.source.ts_ms").alias("source_ts_ms"),
        F.col("data.source.table").alias("source_table"),
        F.col("data.source.connector").alias("connector"),
        F.col("data.source.lsn").alias("lsn"),
        F.col("data.before.id").alias("before_id"),
        F.col("data.before.email").alias("before_email"),
        F.col("data.after.id").alias("after_id"),
        F.col("data.after.first_name").alias("after_first_name"),
        F.col("data.after.last_name").alias("after_last_name"),
        F.col("data.after.email").alias("after_email"),
        F.col("data.after.created_at").alias("after_created_at"),
    )


@_query
def parse_changes_products(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse.parse_changes(_product_records(spark, d), "products")
    return parsed.select(
        F.col("data.op").alias("op"),
        F.col("data.source.ts_ms").alias("source_ts_ms"),
        F.col("data.before.price").alias("before_price"),
        F.col("data.before.quantity_in_stock").alias("before_stock"),
        F.col("data.after.id").alias("after_id"),
        F.col("data.after.name").alias("after_name"),
        F.col("data.after.category").alias("after_category"),
        F.col("data.after.price").alias("after_price"),
        F.col("data.after.quantity_in_stock").alias("after_stock"),
    )


def _flat_customers(flat: DataFrame, *extra: str) -> DataFrame:
    return flat.select(
        "kafka_timestamp",
        *extra,
        "operation",
        "table_name",
        "source_timestamp",
        F.col("before_data.id").alias("before_id"),
        F.col("before_data.email").alias("before_email"),
        F.col("after_data.id").alias("after_id"),
        F.col("after_data.email").alias("after_email"),
    )


@_query
def parse_wrapped_changes(spark: SparkSession, d: str) -> DataFrame:
    flat = parse.parse_wrapped_changes(_customer_records(spark, d), "customers", ["id", "email"])
    return _flat_customers(flat, "schema_name", "schema_version")


@_query
def parse_change_paths(spark: SparkSession, d: str) -> DataFrame:
    return parse.parse_change_paths(_customer_records(spark, d))


@_query
def parse_change_paths_typed(spark: SparkSession, d: str) -> DataFrame:
    return parse.parse_change_paths(_customer_records(spark, d), typed=True)


@_query
def variant_change_paths(spark: SparkSession, d: str) -> DataFrame:
    """The typed paths of ``parse_change_paths`` from messages of no declared type."""
    paths = {
        "operation": ("op", "string"),
        "customer_id": ("after.id", "bigint"),
        "first_name": ("after.first_name", "string"),
        "last_name": ("after.last_name", "string"),
        "email": ("after.email", "string"),
        "source_timestamp": ("source.ts_ms", "bigint"),
    }
    return variants.change_paths(_customer_records(spark, d), paths)


@_query
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Fields of customers and products as they arrive, against their first row types."""
    records = _customer_records(spark, d).unionByName(_product_records(spark, d))
    return variants.schema_drift(variants.seen_fields(records), ["customers", "products"])


@_query
def changes(spark: SparkSession, d: str) -> DataFrame:
    return _flat_customers(_customer_changes(spark, d, "id", "email"))


@_query
def message_metadata(spark: SparkSession, d: str) -> DataFrame:
    records = feeds.opaque_feed(_t(spark, d, "customer"))
    seen = parse.message_metadata(records)
    return seen.withColumn("avro_value", F.hex("avro_value"))


@_query
def first_messages(spark: SparkSession, d: str) -> DataFrame:
    records = feeds.opaque_feed(_t(spark, d, "customer"))
    return parse.first_messages(records).withColumn("avro_value", F.hex("avro_value"))


@_query
def topic_ops(spark: SparkSession, d: str) -> DataFrame:
    return parse.topic_ops(_all_records(spark, d))


@_query
def evolved_customers(spark: SparkSession, d: str) -> DataFrame:
    return parse.evolved_changes(_customer_records(spark, d)).select(
        "operation",
        F.coalesce("after_data.id", "before_data.id").alias("id"),
        F.coalesce("after_data.email", "before_data.email").alias("email"),
        F.coalesce("after_data.phone", "before_data.phone").alias("phone"),
    )


# ---- change analysis ------------------------------------------------------------------------


@_query
def op_counts(spark: SparkSession, d: str) -> DataFrame:
    return ch.op_counts(_customer_changes(spark, d, "id"))


@_query
def inserted_rows(spark: SparkSession, d: str) -> DataFrame:
    return ch.inserted_rows(_customer_changes(spark, d))


@_query
def updated_emails(spark: SparkSession, d: str) -> DataFrame:
    return ch.updated_emails(_customer_changes(spark, d, "id", "email"))


@_query
def updated_emails_timed(spark: SparkSession, d: str) -> DataFrame:
    return ch.updated_emails_timed(_customer_changes(spark, d, "id", "email"))


@_query
def email_changes(spark: SparkSession, d: str) -> DataFrame:
    names = ("id", "first_name", "last_name", "email")
    return ch.email_changes(_customer_changes(spark, d, *names))


@_query
def deleted_rows(spark: SparkSession, d: str) -> DataFrame:
    return ch.deleted_rows(_customer_changes(spark, d))


@_query
def price_changes(spark: SparkSession, d: str) -> DataFrame:
    return ch.price_changes(_product_changes(spark, d))


@_query
def stock_changes(spark: SparkSession, d: str) -> DataFrame:
    return ch.stock_changes(_product_changes(spark, d))


def _item_changes(spark: SparkSession, d: str) -> DataFrame:
    return parse.changes(feeds.order_item_feed(_t(spark, d, "lineitem")), "order_items")


@_query
def inserted_order_items(spark: SparkSession, d: str) -> DataFrame:
    return ch.inserted_rows(_item_changes(spark, d))


@_query
def deleted_order_items(spark: SparkSession, d: str) -> DataFrame:
    return ch.deleted_rows(_item_changes(spark, d))


@_query
def schema_versions(spark: SparkSession, d: str) -> DataFrame:
    records = _customer_records(spark, d)
    return ch.schema_versions(parse.parse_wrapped_changes(records, "customers", ["id"]))


@_query
def history_op_counts(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "history")
    replay.write_records(_order_records(spark, d), path)
    return ch.history_op_counts(parse.topic_ops(replay.replay_history(spark, path)))


@_query
def batch_volume(spark: SparkSession, d: str) -> DataFrame:
    """Rows per micro-batch of a stream in two batches."""

    def start(records, out, checkpoint):
        ops = parse.topic_ops(records)
        return runner.run_stream(ops, sinks.batch_table(out, ch.batch_volume), checkpoint)

    out = _replayed(spark, "volume", _customer_arrivals(spark, d), start)
    return sinks.read_batches(spark, out, monitor.VOLUME)


# ---- streaming ------------------------------------------------------------------------------


@_query
def change_metrics(spark: SparkSession, d: str) -> DataFrame:
    watch = partial(monitor.watch_metrics, state_partitions=STATE_PARTITIONS)
    out = _replayed(spark, "metrics-stream", _mixed_arrivals(spark, d), watch)
    return monitor.current_metrics(spark, out)


@_query
def change_metrics_history(spark: SparkSession, d: str) -> DataFrame:
    return metrics.change_metrics(parse.topic_ops(_all_records(spark, d)))


@_query
def op_stats(spark: SparkSession, d: str) -> DataFrame:
    arrivals = [feeds.event_feed(p) for p in _slices(_t(spark, d, "events"), "ts")]
    watch = partial(monitor.watch_stats, state_partitions=STATE_PARTITIONS)
    return monitor.current_stats(spark, _replayed(spark, "stats-stream", arrivals, watch))


@_query
def op_stats_complete(spark: SparkSession, d: str) -> DataFrame:
    """Complete mode: every window of the last trigger, in order."""
    arrivals = [feeds.event_feed(p) for p in _slices(_t(spark, d, "events"), "ts")]
    watch = partial(monitor.watch_stats, state_partitions=STATE_PARTITIONS, complete=True)
    return sinks.latest_table(spark, _replayed(spark, "complete-stream", arrivals, watch), monitor.STATS)


@_query
def open_windows(spark: SparkSession, d: str) -> DataFrame:
    """The counts that a stream still holds, read from its checkpoint after two runs."""
    watch = partial(monitor.watch_metrics, state_partitions=STATE_PARTITIONS)
    out = _replayed(spark, "audited-stream", _mixed_arrivals(spark, d), watch)
    return metrics.kept_windows(spark, f"{out.removesuffix('/out')}/checkpoint")


@_query
def late_changes(spark: SparkSession, d: str) -> DataFrame:
    """Update mode with a quarter of the orders arriving late: those whose window closed before
    the watermark are dropped.
    """
    orders = _t(spark, d, "orders")
    late = F.col("o_orderkey") % 4 == 0
    arrivals = [feeds.order_feed(_spread(orders.filter(of), "o_orderkey")) for of in (~late, late)]
    watch = partial(monitor.watch_metrics, state_partitions=STATE_PARTITIONS)
    out = _replayed(spark, "late-stream", arrivals, watch)
    return monitor.current_metrics(spark, out)


@_query
def run_all(spark: SparkSession, d: str) -> DataFrame:
    """The three monitoring queries side by side; the rows of their results, as text."""
    watch = partial(monitor.run_all, state_partitions=STATE_PARTITIONS)
    out = _replayed(spark, "all", _mixed_arrivals(spark, d), watch, by_topic=True)
    results = {
        "inserted": (f"{out}/customers/inserted", monitor.INSERTED),
        "email_changes": (f"{out}/customers/email_changes", monitor.EMAIL_CHANGES),
        "price_changes": (f"{out}/products/price_changes", monitor.PRICE_CHANGES),
        "stock_changes": (f"{out}/products/stock_changes", monitor.STOCK_CHANGES),
    }
    frames = {n: sinks.read_batches(spark, p, ddl).drop("batch_id") for n, (p, ddl) in results.items()}
    metrics_ = monitor.current_metrics(spark, f"{out}/metrics")
    minute = F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("minute")
    frames["metrics"] = metrics_.select(minute, "table_name", "operation", "change_count")
    return _as_text(frames)


def _as_text(frames: dict[str, DataFrame]) -> DataFrame:
    """result and row: every row of every frame, its values joined."""
    stacked = [
        df.select(
            F.lit(name).alias("result"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("row"),
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, stacked)


# ---- sales, retention, quality --------------------------------------------------------------


@_query
def staging_sales(spark: SparkSession, d: str) -> DataFrame:
    return sales.staging_sales(_raw(spark, d).withColumn("sale_date", F.to_date("created_at")))


@_query
def extract_daily_sales(spark: SparkSession, d: str) -> DataFrame:
    """The sales of the last day on record."""
    return sales.extract_daily_sales(_raw(spark, d), _last_order_day(spark, d))


@_query
def daily_metrics(spark: SparkSession, d: str) -> DataFrame:
    return sales.daily_metrics(_staging(spark, d))


@_query
def retain_recent(spark: SparkSession, d: str) -> DataFrame:
    return sales.retain_recent(_staging(spark, d), _last_order_day(spark, d))


@_query
def validate_extract(spark: SparkSession, d: str) -> DataFrame:
    return quality.validate_extract(_staging(spark, d), _raw(spark, d))


@_query
def daily_report(spark: SparkSession, d: str) -> DataFrame:
    return sales.daily_report(sales.daily_metrics(_staging(spark, d)))


@_query
def daily_sales_run(spark: SparkSession, d: str) -> DataFrame:
    """A backfill by month, then runs of single days: the last three, and again the last, by then
    without sales. The raw sales are joined once and stored; each step of each run reads them again.
    """
    base = scratch_dir(spark, "daily-sales")
    last_day, raw = _last_order_day(spark, d), stored(_raw(spark, d), "raw-sales")
    daily_sales.run_day(spark, raw, base, last_day, backfill=True, grain="month")
    for back in (2, 1, 0):
        daily_sales.run_day(spark, raw, base, last_day - dt.timedelta(days=back), grain="month")
    gone = raw.filter(F.to_date("created_at") < F.lit(last_day))
    return daily_sales.run_day(spark, gone, base, last_day, grain="month")


@_query
def cohort_retention(spark: SparkSession, d: str) -> DataFrame:
    return retention.cohort_retention(_activity(spark, d))


@_query
def cohort_sizes(spark: SparkSession, d: str) -> DataFrame:
    return retention.cohort_sizes(_activity(spark, d))


@_query
def daily_retention(spark: SparkSession, d: str) -> DataFrame:
    return retention.daily_retention(_activity(spark, d))


def _kept_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells kept day after day: the activity in three slices, the middle one once more at the end."""
    activity = _activity(spark, d)
    path = scratch_dir(spark, "cells")
    slices = _slices(activity, "activity_time", 3)
    for part in [*slices, slices[1]]:
        cohort_bitmaps.add(part, path)
    return cohort_bitmaps.kept(spark, path)


@_query
def kept_cohort_retention(spark: SparkSession, d: str) -> DataFrame:
    return cohort_bitmaps.cohort_retention(_kept_cells(spark, d))


@_query
def kept_active_users(spark: SparkSession, d: str) -> DataFrame:
    return cohort_bitmaps.active_users(_kept_cells(spark, d))


def _totals(spark: SparkSession, d: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "events")
    return quality.source_totals({n: _t(spark, d, n) for n in names})


@_query
def source_totals(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).withColumn("sources", F.array_join("sources", ","))


@_query
def row_count_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.row_count_gate(_totals(spark, d))


@_query
def reconcile_order_totals(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored(spark, d)
    return quality.reconcile_order_totals(stored["orders"], stored["order_items"])


@_query
def constraint_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.constraint_report(_stored(spark, d))


def _table_changes(spark: SparkSession, d: str) -> list[dict[str, DataFrame]]:
    """Changes of customers and orders in three batches: all rows, then some customers go and some get the
    e-mail of all, then some orders lose their customer or total.
    """
    stored = _stored(spark, d)
    customers, orders = stored["customers"], stored["orders"]

    def changed(df: DataFrame, operation: str, **new: Column) -> DataFrame:
        before, after = F.struct(*df.columns), F.struct(*[new.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
        none = F.lit(None)
        return df.select(
            F.lit(operation).alias("operation"),
            (none.cast(df.select(before).schema[0].dataType) if operation == "c" else before).alias("before_data"),
            (none.cast(df.select(before).schema[0].dataType) if operation == "d" else after).alias("after_data"),
        )

    gone, renamed = customers.filter("id % 10 = 0"), customers.filter("id % 10 = 1")
    lost, empty = orders.filter("id % 7 = 0"), orders.filter("id % 11 = 5 AND id % 7 <> 0")
    return [
        {"customers": changed(customers, "c"), "orders": changed(orders, "c")},
        {"customers": changed(gone, "d").unionByName(changed(renamed, "u", email=F.lit("all@example.com")))},
        {
            "orders": changed(lost, "u", customer_id=F.lit(-1)).unionByName(
                changed(empty, "u", customer_id=F.lit(None), total_amount=F.lit(None))
            )
        },
    ]


@_query
def kept_constraint_report(spark: SparkSession, d: str) -> DataFrame:
    """Violations from counts kept over three batches of changes, the second of them delivered twice."""
    path = scratch_dir(spark, "constraints")
    for batch, found in enumerate(_table_changes(spark, d)):
        for _ in range(1 + batch % 2):
            state_table.update(kept_constraints.signed_values(found), path, kept_constraints.added, 16, batch)
    counts = state_table.read(spark, path, schemas.struct(kept_constraints.COUNTS))
    return kept_constraints.report(counts, ["customers", "orders"])


# ---- change log, state, insight -------------------------------------------------------------


def _log_summary(logged: DataFrame) -> DataFrame:
    after_id = F.get_json_object("after_data", "$.id").try_cast("bigint")
    before_id = F.get_json_object("before_data", "$.id").try_cast("bigint")
    return logged.groupBy("table_name", "event_date", "operation").agg(
        F.count(F.lit(1)).alias("change_count"),
        F.sum(F.coalesce(after_id, before_id)).alias("id_sum"),
        F.max("offset").alias("last_offset"),
    )


@_query
def change_log(spark: SparkSession, d: str) -> DataFrame:
    def start(records, out, checkpoint):
        return monitor.keep_change_log(records, out, checkpoint, grain="month")

    out = _replayed(spark, "change-log", _mixed_arrivals(spark, d), start)
    return _log_summary(monitor.change_log(spark, out))


@_query
def compacted_change_log(spark: SparkSession, d: str) -> DataFrame:
    """The log of four batches, compacted after each; the last one always stays as it is."""

    def start(records, out, checkpoint):
        query = monitor.keep_change_log(records, out, checkpoint, grain="year")
        runner.drain(query)
        monitor.compact_change_log(spark, out)
        return query

    orders = [feeds.order_feed(_spread(p, "o_orderkey")) for p in _slices(_t(spark, d, "orders"), "o_orderdate", 2)]
    rest = [_customer_records(spark, d), _product_records(spark, d)]
    out = _replayed(spark, "compacted-log", [*orders, *rest], start)
    return _log_summary(monitor.change_log(spark, out))


@_query
def recoverable_stream(spark: SparkSession, d: str) -> DataFrame:
    """Three runs on one checkpoint: every change once, none lost."""

    def start(records, out, checkpoint):
        parsed = parse.changes(records, "customers", ["id"])
        kept = parsed.select("offset", "operation", "source_timestamp")
        return runner.run_stream(kept, sinks.batch_table(out), checkpoint)

    out = _replayed(spark, "recoverable", _customer_arrivals(spark, d, 3), start)
    ddl = "offset bigint, operation string, source_timestamp bigint"
    return sinks.read_batches(spark, out, ddl)


@_query
def current_state(spark: SparkSession, d: str) -> DataFrame:
    return state.current_state(_history_changes(spark, d))


@_query
def address_state(spark: SparkSession, d: str) -> DataFrame:
    return state.current_state(parse.changes(feeds.address_feed(_t(spark, d, "supplier")), "addresses"))


@_query
def merged_state(spark: SparkSession, d: str) -> DataFrame:
    """State kept as a table and brought up to date with the second half of the changes."""
    earlier, later = [
        parse.changes(feeds.customer_history_feed(p), "customers")
        for p in _slices(_t(spark, d, "orders"), "o_orderdate")
    ]
    path = scratch_dir(spark, "latest")
    state.latest_changes(earlier).write.parquet(path)
    return state.live_rows(state.merge_latest(spark.read.parquet(path), later))


@_query
def kept_state(spark: SparkSession, d: str) -> DataFrame:
    """State as a bucketed table that a stream brings up to date in three batches."""

    def start(records, out, checkpoint):
        return monitor.keep_state(records, "customers", out, checkpoint, buckets=16)

    arrivals = [feeds.customer_history_feed(p) for p in _slices(_t(spark, d, "orders"), "o_orderdate", 3)]
    out = _replayed(spark, "kept-state", arrivals, start)
    return state_table.live(spark, out, schemas.row_schema("customers"))


@_query
def enrich_changes(spark: SparkSession, d: str) -> DataFrame:
    columns = ["id", "customer_id", "total_amount", "status"]
    order_changes = parse.changes(_order_records(spark, d), "orders", columns)
    return insight.enrich_changes(order_changes, _stored(spark, d)["customers"])


@_query
def enrich_changes_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Order changes with their customer as it was by then, from the customers' history."""
    columns = ["id", "customer_id", "total_amount", "status"]
    order_changes = parse.changes(_order_records(spark, d), "orders", columns)
    return insight.enrich_changes_as_of(order_changes, _history_changes(spark, d))


@_query
def enrich_change_stream(spark: SparkSession, d: str) -> DataFrame:
    customers = _stored(spark, d)["customers"]

    def start(records, out, checkpoint):
        return monitor.watch_orders(records, customers, out, checkpoint)

    arrivals = [feeds.order_feed(_spread(p, "o_orderkey")) for p in _slices(_t(spark, d, "orders"), "o_orderdate")]
    out = _replayed(spark, "enriched", arrivals, start)
    return sinks.read_batches(spark, f"{out}/enriched", monitor.ENRICHED).drop("batch_id")


@_query
def order_lines_stream(spark: SparkSession, d: str) -> DataFrame:
    """New orders and their new items as two streams, in three batches, or more of about ``ARRIVAL_ROWS``."""
    orders, lineitem = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    low, high, rows = orders.agg(F.min("o_orderdate"), F.max("o_orderdate"), F.count(F.lit(1))).first()
    n = max(3, -(-(rows + lineitem.count()) // ARRIVAL_ROWS))
    edges = [None, *([low + (high - low) * i / n for i in range(1, n)] if low else []), None]
    made = (
        (orders, "o_orderdate", "o_orderkey", feeds.order_feed),
        (lineitem, "l_shipdate", "l_orderkey", feeds.order_item_feed),
    )
    arrivals = []
    for start, end in zip(edges, edges[1:]):
        parts = []
        for df, column, key, feed in made:
            of = df if start is None else df.filter(F.col(column) >= F.lit(start))
            parts.append(feed(_spread(of if end is None else of.filter(F.col(column) < F.lit(end)), key)))
        arrivals.append(parts[0].unionByName(parts[1]))
    cores = spark.sparkContext.defaultParallelism
    watch = partial(
        monitor.watch_order_lines, late="36 hours", within="60 days", state_partitions=max(STATE_PARTITIONS, cores)
    )
    out = _replayed(spark, "order-lines", arrivals, watch)
    return sinks.read_batches(spark, out, monitor.ORDER_LINES).drop("batch_id")


@_query
def observed_volume(spark: SparkSession, d: str) -> DataFrame:
    """Rows per micro-batch as the batch itself reports them."""
    path = scratch_dir(spark, "progress")

    def start(records, out, checkpoint):
        return runner.run_stream(progress.observed(parse.topic_ops(records)), sinks.batch_table(out), checkpoint)

    with progress.recording(spark, path):
        _replayed(spark, "observed", _customer_arrivals(spark, d), start)
    found = progress.read(spark, path).filter("observed['rows'] > 0")
    return found.select(F.col("observed")["rows"].alias("change_count"), "batch_id")


@_query
def observed_late_changes(spark: SparkSession, d: str) -> DataFrame:
    """What the stream of ``late_changes`` reports of itself: rows read and the watermark it came to."""
    orders = _t(spark, d, "orders")
    late = F.col("o_orderkey") % 4 == 0
    arrivals = [feeds.order_feed(_spread(orders.filter(of), "o_orderkey")) for of in (~late, late)]
    path = scratch_dir(spark, "progress")
    with progress.recording(spark, path):
        _replayed(spark, "observed-late", arrivals, partial(monitor.watch_metrics, state_partitions=STATE_PARTITIONS))
    found = progress.read(spark, path)
    return found.agg(F.sum("input_rows").alias("change_count"), F.max("watermark").alias("watermark"))


@_query
def transaction_anomalies(spark: SparkSession, d: str) -> DataFrame:
    flagged = insight.transaction_anomalies(_stored(spark, d)["orders"])
    return flagged.select("order_id", "customer_id", "total_amount", "order_count")


@_query
def kept_transaction_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Limits from moments kept per customer and merged in three batches, the second of them twice."""
    orders = _stored(spark, d)["orders"]
    path = scratch_dir(spark, "moments")
    for batch, part in enumerate(_slices(orders, "id", 3)):
        for _ in range(1 + batch % 2):
            state_table.update(insight.order_moments(part), path, insight.merged_moments, 16, batch)
    moments = state_table.read(spark, path, schemas.struct(insight.MOMENTS))
    flagged = insight.anomalies_from_moments(orders, moments)
    return flagged.select("order_id", "customer_id", "total_amount", "order_count")


@_query
def restock_alerts(spark: SparkSession, d: str) -> DataFrame:
    return insight.restock_alerts(_product_changes(spark, d))


@_query
def customer_activity_change(spark: SparkSession, d: str) -> DataFrame:
    return insight.customer_activity_change(_t(spark, d, "events"))
