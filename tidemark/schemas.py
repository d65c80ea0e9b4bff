"""Row types of the captured tables, the change envelope around them and the sales tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Row images as they appear inside change messages. Row times are raw epoch numbers.
ROW_FIELDS = {
    "customers": "id bigint, first_name string, last_name string, email string, "
    "created_at bigint, updated_at bigint",
    "customers_evolved": "id bigint, first_name string, last_name string, email string, "
    "phone string, created_at bigint, updated_at bigint",
    "products": "id bigint, name string, description string, price decimal(10,2), "
    "quantity_in_stock int, category string, created_at bigint, updated_at bigint",
    "orders": "id bigint, customer_id bigint, total_amount decimal(10,2), status string, "
    "order_date bigint, updated_at bigint",
    "order_items": "id bigint, order_id bigint, product_id bigint, quantity int, "
    "unit_price decimal(10,2), created_at bigint",
    "addresses": "id bigint, customer_id bigint, street_address string, city string, state string, "
    "postal_code string, country string, address_type string, "
    "created_at bigint, updated_at bigint",
}

# The same tables as stored, with timestamps.
TABLE_SCHEMAS = {
    "customers": "id bigint, first_name string, last_name string, email string, "
    "created_at timestamp, updated_at timestamp",
    "products": "id bigint, name string, description string, price decimal(10,2), "
    "quantity_in_stock int, category string, created_at timestamp, updated_at timestamp",
    "orders": "id bigint, customer_id bigint, total_amount decimal(10,2), status string, "
    "order_date timestamp, updated_at timestamp",
    "order_items": "id bigint, order_id bigint, product_id bigint, quantity int, "
    "unit_price decimal(10,2), created_at timestamp",
    "addresses": "id bigint, customer_id bigint, street_address string, city string, state string, "
    "postal_code string, country string, address_type string, "
    "created_at timestamp, updated_at timestamp",
}

# Sales staging and the raw sales it is filled from.
RAW_SALES = (
    "customer_id bigint, product_id bigint, quantity int, price decimal(10,2), created_at timestamp"
)
STAGING_SALES = (
    "customer_id bigint, product_id bigint, quantity int, price decimal(10,2), "
    "created_at timestamp, sale_date date"
)
DAILY_METRICS = (
    "total_transactions bigint, total_revenue decimal(20,2), avg_transaction_value double, "
    "unique_customers bigint, sale_date date"
)

# The columns a Kafka source yields; replay directories hold the same columns.
RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

# Origin details in a change message.
SOURCE_FIELDS = (
    "version string, connector string, name string, ts_ms bigint, snapshot string, db string, "
    "schema string, table string, txId bigint, lsn bigint"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def row_schema(table: str) -> T.StructType:
    return struct(ROW_FIELDS[table])


def change_body(row: T.DataType, source: str = "ts_ms bigint, table string") -> T.StructType:
    """before / after / source / op for rows of type ``row``."""
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("source", struct(source)),
            T.StructField("op", T.StringType()),
        ]
    )


def either_envelope(body: T.StructType) -> T.StructType:
    """Superset of both message shapes: the body at top level, or below ``payload``."""
    return T.StructType(
        body.fields
        + [
            T.StructField("schema", struct("name string, version int")),
            T.StructField("payload", body),
        ]
    )
