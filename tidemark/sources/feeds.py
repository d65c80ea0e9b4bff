"""Deterministic change feeds over the test tables.

Each feed turns plain table rows into the records a message broker would deliver: binary key, binary
JSON value, topic, partition, offset and time. Column formulas are simple arithmetic on the row key,
so that the expected result of any operator can be stated in SQL on the plain table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Base time 2024-01-01 00:00:00 UTC in ms, and the number of topic partitions.
T0 = 1704067200000
PARTITIONS = 4

TOPIC_PREFIX = "shop.sales"


def topic_name(table: str, prefix: str = TOPIC_PREFIX) -> str:
    return f"{prefix}.{table}"


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _image(present: Column, *cols: Column) -> Column:
    return F.when(present, F.struct(*cols))


def _source(table: str, ts_ms: Column, key: Column) -> Column:
    return F.struct(
        F.lit("2.4").alias("version"),
        F.lit("postgresql").alias("connector"),
        F.lit("shop").alias("name"),
        ts_ms.alias("ts_ms"),
        F.lit("false").alias("snapshot"),
        F.lit("shop").alias("db"),
        F.lit("sales").alias("schema"),
        F.lit(table).alias("table"),
        key.alias("txId"),
        (key * 8).alias("lsn"),
    )


def _described(table: str, version: Column) -> Column:
    """The ``schema`` half of a wrapped message."""
    field = [
        F.struct(
            F.lit(kind).alias("type"),
            F.lit(True).alias("optional"),
            F.lit(name).alias("field"),
        )
        for name, kind in (("before", "struct"), ("after", "struct"), ("op", "string"))
    ]
    return F.struct(
        F.lit("struct").alias("type"),
        F.array(*field).alias("fields"),
        F.lit(False).alias("optional"),
        F.lit(f"{topic_name(table)}.Envelope").alias("name"),
        version.alias("version"),
    )


def _record(
    rows: DataFrame, table: str, value: Column, time: Column | None = None
) -> DataFrame:
    """``rows`` needs key ``k``, offset ``seq`` and change time ``ts_ms``. Text is UTF-8 already, so the cast
    to bytes copies nothing; ``encode`` would decode it first.
    """
    if time is None:
        time = F.timestamp_millis(F.col("ts_ms"))
    return rows.select(
        _json(F.col("k").cast("bigint").alias("id")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic_name(table)).alias("topic"),
        F.pmod(F.col("k"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        time.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _body(table: str, before: Column, after: Column) -> list[Column]:
    return [
        before.alias("before"),
        after.alias("after"),
        _source(table, F.col("ts_ms"), F.col("k")).alias("source"),
        F.col("op").alias("op"),
        (F.col("ts_ms") + 5).alias("ts_ms"),
        F.lit(None).cast("string").alias("transaction"),
    ]


def customer_feed(customer: DataFrame) -> DataFrame:
    """One change per customer; bare messages for even keys, wrapped ones for odd keys.

    Every third row uses the evolved row type, which adds ``phone`` (schema version 2).
    """
    k = F.col("c_custkey")
    digit = k % 10
    old_email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    rows = customer.select(
        k.alias("k"),
        k.alias("seq"),
        (F.lit(T0) + k * 1000 + 999).alias("ts_ms"),
        F.when(digit == 0, "d").when(digit <= 3, "u").when(digit == 4, "r").otherwise("c").alias("op"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        old_email.alias("old_email"),
        F.when((k % 20).isin(1, 2, 3), F.concat(F.lit("new."), old_email))
        .otherwise(old_email)
        .alias("new_email"),
        F.when(k % 3 == 0, 2).otherwise(1).alias("version"),
        F.when(k % 3 == 0, F.concat(F.lit("555-"), k.cast("string"))).alias("phone"),
    )

    def image(present: Column, email: str, phone: list[Column]) -> Column:
        common = [
            F.col("k").cast("bigint").alias("id"),
            F.col("first_name"),
            F.col("last_name"),
            F.col(email).alias("email"),
        ]
        times = [(F.lit(T0) + F.col("k")).alias("created_at"), F.col("ts_ms").alias("updated_at")]
        return _image(present, *common, *phone, *times)

    def message(phone: list[Column]) -> Column:
        body = _body(
            "customers",
            image(F.col("op").isin("u", "d"), "old_email", phone),
            image(F.col("op") != "d", "new_email", phone),
        )
        described = _described("customers", F.col("version")).alias("schema")
        wrapped = _json(described, F.struct(*body).alias("payload"))
        return F.when(F.col("k") % 2 == 0, _json(*body)).otherwise(wrapped)

    value = F.when(F.col("version") == 2, message([F.col("phone")])).otherwise(message([]))
    return _record(rows, "customers", value)


def order_item_feed(lineitem: DataFrame) -> DataFrame:
    """One change per order line at its shipping date."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = lineitem.select(
        k.alias("k"),
        k.alias("seq"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        F.when(k % 4 == 0, "c").when(k % 4 == 1, "u").when(k % 4 == 2, "d").otherwise("r").alias("op"),
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
    )

    def image(present: Column) -> Column:
        return _image(
            present,
            F.col("k").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
            F.col("ts_ms").alias("created_at"),
        )

    body = _body("order_items", image(F.col("op").isin("u", "d")), image(F.col("op") != "d"))
    return _record(rows, "order_items", _json(*body))


def address_columns() -> list[Column]:
    """An address per supplier, whose key also names the customer."""
    nation = F.col("s_nationkey").cast("string")
    return [
        F.col("s_suppkey").alias("id"),
        F.col("s_suppkey").alias("customer_id"),
        F.col("s_name").alias("street_address"),
        F.concat(F.lit("city "), nation).alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.concat(F.lit("P-"), F.col("s_suppkey").cast("string")).alias("postal_code"),
        F.concat(F.lit("country "), nation).alias("country"),
        F.when(F.col("s_suppkey") % 2 == 0, "billing").otherwise("shipping").alias("address_type"),
    ]


def address_feed(supplier: DataFrame) -> DataFrame:
    """Two changes per address: it is created, then moved or, every fifth, deleted."""
    k = F.col("s_suppkey")
    rows = supplier.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("step")).select(
        "s_suppkey",
        "s_name",
        "s_nationkey",
        k.alias("k"),
        (k * 2 + F.col("step")).alias("seq"),
        (F.lit(T0) + k * 1000 + F.col("step")).alias("ts_ms"),
        F.when(F.col("step") == 0, "c").when(k % 5 == 0, "d").otherwise("u").alias("op"),
        "step",
    )

    def image(present: Column, moved: Column) -> Column:
        columns = address_columns()
        columns[2] = F.when(moved, F.concat(F.lit("new "), F.col("s_name"))).otherwise(F.col("s_name"))
        times = [F.lit(T0).alias("created_at"), F.col("ts_ms").alias("updated_at")]
        return _image(present, *columns[:2], columns[2].alias("street_address"), *columns[3:], *times)

    body = _body(
        "addresses",
        image(F.col("op") != "c", F.lit(False)),
        image(F.col("op") != "d", F.col("op") == "u"),
    )
    return _record(rows, "addresses", _json(*body))


def product_feed(part: DataFrame) -> DataFrame:
    """One change per part, with price and stock movements; every eleventh old price is missing."""
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    rows = part.select(
        k.alias("k"),
        k.alias("seq"),
        (F.lit(T0) + k * 500).alias("ts_ms"),
        F.when(k % 5 == 0, "c").when(k % 5 == 4, "d").otherwise("u").alias("op"),
        "p_name",
        "p_type",
        F.when(k % 11 != 0, price).alias("old_price"),
        F.when(k % 4 == 0, (price + 1).cast("decimal(10,2)")).otherwise(price).alias("new_price"),
        F.col("p_size").alias("old_stock"),
        (F.col("p_size") + k % 3 - 1).cast("int").alias("new_stock"),
    )

    def image(present: Column, side: str) -> Column:
        return _image(
            present,
            F.col("k").cast("bigint").alias("id"),
            F.col("p_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
            F.col(f"{side}_price").alias("price"),
            F.col(f"{side}_stock").alias("quantity_in_stock"),
            F.col("p_type").alias("category"),
            F.lit(T0).alias("created_at"),
            F.col("ts_ms").alias("updated_at"),
        )

    body = _body(
        "products",
        image(F.col("op").isin("u", "d"), "old"),
        image(F.col("op") != "d", "new"),
    )
    return _record(rows, "products", _json(*body))


def order_feed(orders: DataFrame) -> DataFrame:
    """One change per order at its order date."""
    k = F.col("o_orderkey")
    rows = orders.select(
        k.alias("k"),
        k.alias("seq"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.when(k % 3 == 0, "c").when(k % 3 == 1, "u").otherwise("d").alias("op"),
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(10,2)").alias("total"),
    )

    def image(present: Column) -> Column:
        return _image(
            present,
            F.col("k").cast("bigint").alias("id"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            F.col("total").alias("total_amount"),
            F.col("o_orderstatus").alias("status"),
            F.col("ts_ms").alias("order_date"),
            F.col("ts_ms").alias("updated_at"),
        )

    body = _body("orders", image(F.col("op").isin("u", "d")), image(F.col("op") != "d"))
    return _record(rows, "orders", _json(*body))


def customer_history_feed(orders: DataFrame) -> DataFrame:
    """Many changes per customer: each order rewrites its customer's row at the order date.

    Every tenth order deletes the row; a later one brings it back.
    """
    k = F.col("o_orderkey")
    digit = k % 10
    rows = orders.select(
        F.col("o_custkey").alias("k"),
        k.alias("seq"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.when(digit == 0, "d").when(digit <= 2, "c").otherwise("u").alias("op"),
        "o_orderstatus",
        "o_orderpriority",
    )

    def image(present: Column) -> Column:
        return _image(
            present,
            F.col("k").cast("bigint").alias("id"),
            F.col("o_orderstatus").alias("first_name"),
            F.col("o_orderpriority").alias("last_name"),
            F.concat(F.lit("order."), F.col("seq").cast("string"), F.lit("@example.com")).alias(
                "email"
            ),
            F.col("ts_ms").alias("created_at"),
            F.col("ts_ms").alias("updated_at"),
        )

    body = _body("customers", image(F.col("op").isin("u", "d")), image(F.col("op") != "d"))
    return _record(rows, "customers", _json(*body))


def event_feed(events: DataFrame) -> DataFrame:
    """One change per event, its type as the operation; types other than c, r, u, d are counted
    like any operation.
    """
    rows = events.select(
        F.col("event_id").alias("k"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("op"),
        "user_id",
        "value",
    ).withColumn("ts_ms", F.unix_millis("ts"))
    after = F.struct(F.col("k").cast("bigint").alias("id"), "user_id", "value")
    body = _body("events", F.lit(None).cast("string"), after)
    return _record(rows, "events", _json(*body), F.col("ts"))


def opaque_feed(customer: DataFrame) -> DataFrame:
    """Registry-framed binary messages: a zero byte, a four-byte schema id, then the payload."""
    k = F.col("c_custkey")
    rows = customer.select(
        k.alias("k"), k.alias("seq"), (F.lit(T0) + k * 1000).alias("ts_ms"), "c_name"
    )
    framed = F.concat(F.unhex(F.lit("0000000001")), F.encode(F.col("c_name"), "UTF-8"))
    return rows.select(
        F.encode(F.col("k").cast("string"), "UTF-8").alias("key"),
        framed.alias("value"),
        F.lit(topic_name("customers", "shop-avro.sales")).alias("topic"),
        F.pmod(F.col("k"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.timestamp_millis(F.col("ts_ms")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def stored_tables(test_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five captured tables laid over the test tables of the same meaning."""
    customer, part = test_tables["customer"], test_tables["part"]
    orders, lineitem = test_tables["orders"], test_tables["lineitem"]
    return {
        "customers": customer.select(
            F.col("c_custkey").cast("bigint").alias("id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.lower("c_name").alias("email"),
        ),
        "products": part.select(
            F.col("p_partkey").cast("bigint").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        ),
        "orders": orders.select(
            F.col("o_orderkey").cast("bigint").alias("id"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        ),
        "order_items": lineitem.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").cast("bigint").alias("order_id"),
            F.col("l_partkey").cast("bigint").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        ),
        "addresses": test_tables["supplier"].select(*address_columns()),
    }


def raw_sales(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order lines with their order's customer and time, in the raw sales layout."""
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def user_activity(events: DataFrame) -> DataFrame:
    """user_id, signup_time and activity_time, one row per user and active day.

    Signup is a user's first event. Events are folded to one row per user and day before the
    per-user minimum is taken, so a user with any number of events brings at most one row per
    calendar day into the window.
    """
    daily = (
        events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("activity_time"))
    )
    signup = F.min("activity_time").over(Window.partitionBy("user_id"))
    return daily.select("user_id", signup.alias("signup_time"), "activity_time")
