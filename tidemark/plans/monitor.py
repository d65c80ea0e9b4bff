"""The monitoring programs: customer changes, product alerts, windowed metrics, change log.

Each takes records (from Kafka or a replay directory), an output folder and a checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import changes as ch
from tidemark.operators import insight, metrics, parse
from tidemark.sources import state_table
from tidemark.streaming import runner, sinks

TOPIC_PREFIX = "shop.sales"

METRICS = (
    "window_start timestamp, window_end timestamp, table_name string, operation string, "
    "change_count bigint"
)
STATS = (
    "window_start timestamp, window_end timestamp, operation string, change_count bigint"
)
OP_COUNTS = "operation string, change_count bigint"
VOLUME = "change_count bigint"
INSERTED = (
    "id bigint, first_name string, last_name string, email string, created_at bigint, updated_at bigint"
)
EMAIL_CHANGES = (
    "customer_id bigint, first_name string, last_name string, old_email string, new_email string"
)
PRICE_CHANGES = (
    "product_id bigint, product_name string, old_price decimal(10,2), new_price decimal(10,2)"
)
STOCK_CHANGES = (
    "product_id bigint, product_name string, old_stock int, new_stock int, change int"
)
ENRICHED = (
    "customer_id bigint, order_id bigint, total_amount decimal(10,2), status string, operation string, "
    "source_timestamp bigint, first_name string, last_name string, email string"
)
ORDER_LINES = (
    "order_id bigint, customer_id bigint, total_amount decimal(10,2), order_time timestamp, item_id bigint, "
    "product_id bigint, quantity int, unit_price decimal(10,2), item_time timestamp"
)
CHANGE_LOG = (
    "topic string, partition int, offset bigint, kafka_timestamp timestamp, operation string, "
    "source_timestamp bigint, before_data string, after_data string, row_key bigint, "
    "table_name string, event_date date"
)


def watch_customers(
    records: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Operation counts, inserted, updated and deleted customers, email changes, schema versions."""
    results = {
        "volume": ch.batch_volume,
        "op_counts": ch.op_counts,
        "schema_versions": ch.schema_versions,
        "inserted": ch.inserted_rows,
        "updated": ch.updated_emails_timed,
        "email_changes": ch.email_changes,
        "deleted": ch.deleted_rows,
    }
    parsed = parse.parse_wrapped_changes(records, "customers")
    write = sinks.batch_tables(results, out)
    return runner.run_stream(parsed, write, checkpoint, every=every, name="customers")


def watch_products(
    records: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Price and stock alerts, and products to restock."""
    results = {
        "price_changes": ch.price_changes,
        "stock_changes": ch.stock_changes,
        "restock_alerts": insight.restock_alerts,
    }
    parsed = parse.changes(records, "products", ["id", "name", "price", "quantity_in_stock"])
    write = sinks.batch_tables(results, out)
    return runner.run_stream(parsed, write, checkpoint, every=every, name="products")


def watch_orders(
    records: DataFrame,
    customers: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Order changes with their customers.

    The join is made per micro-batch, where it is planned adaptively. Each batch reads the customers
    as they are by then, and first of all only those it has changes of: the batch's keys are a small
    side, so of a large table no more than these rows is moved.
    """

    def enriched(batch: DataFrame) -> DataFrame:
        row = F.coalesce("after_data", "before_data")
        named = batch.select(row["customer_id"].alias("id")).distinct()
        return insight.enrich_changes(batch, customers.join(named, "id", "left_semi"))

    columns = ["id", "customer_id", "total_amount", "status"]
    parsed = parse.changes(records, "orders", columns)
    write = sinks.batch_tables({"enriched": enriched}, out)
    return runner.run_stream(parsed, write, checkpoint, every=every, name="orders")


def watch_order_lines(
    records: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    late: str = "1 hour",
    within: str = "1 day",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """New orders with their new items, two streams joined; an order without any by itself.

    An item may follow its order by ``within``, and either may arrive ``late`` behind the newest of its
    kind. What both watermarks have passed can meet nothing more: it leaves the state, and an order
    that met no item is put out, once. So the state holds what came last, not the history.
    """
    read = {
        "orders": ["id", "customer_id", "total_amount"],
        "order_items": ["id", "order_id", "product_id", "quantity", "unit_price"],
    }
    orders, items = (_inserted(records, table, columns).withWatermark("at", late) for table, columns in read.items())
    orders = orders.select(
        F.col("row.id").alias("order_id"), "row.customer_id", "row.total_amount", F.col("at").alias("order_time")
    )
    items = items.select(
        F.col("row.id").alias("item_id"),
        F.col("row.order_id").alias("of_order"),
        *[f"row.{c}" for c in ("product_id", "quantity", "unit_price")],
        F.col("at").alias("item_time"),
    )
    follows = F.expr(f"of_order = order_id AND item_time BETWEEN order_time AND order_time + INTERVAL {within}")
    lines = orders.join(items, follows, "left").drop("of_order")
    return runner.run_stream(
        lines, sinks.batch_table(out), checkpoint, every=every, name="order_lines", state_partitions=state_partitions
    )


def _inserted(records: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """New rows of a table, in ``row``, with the time of their change. Other changes are not parsed."""
    own = records.filter(F.col("topic") == f"{TOPIC_PREFIX}.{table}")
    created = parse.changes(own, table, columns, ["c", "r"])
    return created.select(F.col("after_data").alias("row"), F.timestamp_millis("source_timestamp").alias("at"))


def watch_metrics(
    records: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Counts per minute, table and operation, in update mode; to be sorted by whoever reads them.

    Counts are folded per task before they meet the state, so what arrives there is one row per
    task, window, table and operation. ``state_partitions`` (the session's shuffle partitions, if not
    given) is fixed by the first run on a checkpoint.
    """
    counts = metrics.change_metrics(parse.topic_ops(records))
    write = sinks.batch_table(out)
    return runner.run_stream(
        counts,
        write,
        checkpoint,
        mode="update",
        every=every,
        name="metrics",
        state_partitions=state_partitions,
    )


def watch_stats(
    records: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
    complete: bool = False,
) -> StreamingQuery:
    """Counts per minute and operation, in update mode: windows that are over leave the state.

    With ``complete`` every window since the start is kept, counted however late, and written anew
    at each trigger; read that with ``sinks.latest_table``. Its state grows without bound, so the
    session should keep it in the RocksDB store.
    """
    stats = metrics.op_stats(parse.topic_ops(records), ordered=False)
    write = sinks.whole_table(out, metrics.sorted_stats) if complete else sinks.batch_table(out)
    return runner.run_stream(
        stats,
        write,
        checkpoint,
        mode="complete" if complete else "update",
        every=every,
        name="stats",
        state_partitions=state_partitions,
    )


def keep_change_log(
    records: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    grain: str = "day",
) -> StreamingQuery:
    """Append every change to a table partitioned by table, event date and batch.

    For a replay of a long, thin history, ``grain`` "month" or "year" keeps the folders few.
    """
    event_date = F.to_date(F.timestamp_millis("source_timestamp"))
    images = [F.get_json_object(image, "$.id").try_cast("bigint") for image in ("after_data", "before_data")]
    logged = parse.raw_images(records).withColumns({"event_date": event_date, "row_key": F.coalesce(*images)})
    period = "event_date"
    if grain != "day":
        period = "event_period"
        logged = logged.withColumn(period, F.trunc("event_date", grain))
    write = sinks.partitioned_table(out, ["table_name", period])
    return runner.run_stream(logged, write, checkpoint, every=every, name="change_log")


def keep_state(
    records: DataFrame, table: str, path: str, checkpoint: str, every: str | None = None, buckets: int = 64
) -> StreamingQuery:
    """The rows of ``table`` as they are, in a bucketed table that each micro-batch brings up to date."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state_table.merge(batch, path, buckets=buckets)

    write.output = path
    return runner.run_stream(parse.changes(records, table), write, checkpoint, every=every, name=f"{table}_state")


def run_all(
    subscribe: Callable[[list[str]], DataFrame],
    out: str,
    checkpoint: str,
    every: str | None = None,
    prefix: str = TOPIC_PREFIX,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Customer changes, product alerts and metrics side by side in one session.

    ``subscribe`` gives the records of some topics. Each program subscribes to its own, so no message is
    fetched by a program that has no use for it.

    Follow with ``runner.await_first``, so that the end of any of them is noticed; queries that
    ended before are forgotten here.
    """
    topics = {t: f"{prefix}.{t}" for t in ("customers", "products", "orders")}
    customers, products = subscribe([topics["customers"]]), subscribe([topics["products"]])
    watched = subscribe(list(topics.values()))
    watched.sparkSession.streams.resetTerminated()
    return [
        watch_customers(customers, f"{out}/customers", f"{checkpoint}/customers", every),
        watch_products(products, f"{out}/products", f"{checkpoint}/products", every),
        watch_metrics(watched, f"{out}/metrics", f"{checkpoint}/metrics", every, state_partitions),
    ]


def compact_change_log(spark: SparkSession, path: str) -> int:
    """Fold the finished batches of the log, each table and period for itself, in order of row and time.

    The history of a row then lies together: its key leads to few files, and to few groups in them.
    """
    return sinks.fold_batches(spark, path, CHANGE_LOG, ["row_key", "source_timestamp"])


def change_log(spark: SparkSession, path: str) -> DataFrame:
    columns = [*schemas.struct(CHANGE_LOG).fieldNames(), "batch_id"]
    return sinks.read_batches(spark, path, CHANGE_LOG).select(*columns)


def current_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table with each window's last count."""
    batches = sinks.read_batches(spark, path, METRICS)
    return metrics.latest_metrics(batches, ["table_name", "operation"])


def current_stats(spark: SparkSession, path: str) -> DataFrame:
    """The table of update-mode stats with each window's last count."""
    return metrics.latest_metrics(sinks.read_batches(spark, path, STATS), ["operation"])
