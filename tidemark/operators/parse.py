"""Change messages to typed columns.

Every parser reads a message's JSON exactly once. ``inline`` over a one-element array is what keeps
it so: it puts a Generate node below the field accesses, and the optimizer, which would otherwise
copy ``from_json`` into each filter and field that uses it, leaves the parse alone. Since the value
is opaque to the scan, pruning is done here instead: callers name the row columns they need, and
only these are decoded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def _decode(records: DataFrame, message: T.StructType, *keep: Column | str) -> DataFrame:
    """``keep`` plus one column per top-level field of ``message``."""
    parsed = F.from_json(F.col("value").cast("string"), message)
    return records.select(*keep, F.inline(F.array(parsed)))


def _either(field: str) -> Column:
    """A body field from whichever envelope the message uses."""
    return F.coalesce(F.col(f"payload.{field}"), F.col(field))


def _row(table: str, columns: Sequence[str] | None) -> T.StructType:
    full = schemas.row_schema(table)
    if columns is None:
        return full
    return T.StructType([full[name] for name in columns])


def parse_changes(records: DataFrame, table: str) -> DataFrame:
    """message_key, timestamp and the complete typed message in ``data``; no row is dropped."""
    body = schemas.change_body(schemas.row_schema(table), schemas.SOURCE_FIELDS)
    body = body.add("ts_ms", T.LongType()).add("transaction", T.StringType())
    decoded = _decode(
        records,
        schemas.either_envelope(body),
        F.col("key").cast("string").alias("message_key"),
        "timestamp",
    )
    data = F.struct(*[_either(f).alias(f) for f in body.fieldNames()])
    return decoded.select("message_key", data.alias("data"), "timestamp")


def parse_wrapped_changes(
    records: DataFrame, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Flat changes with the name and version of the schema a message carries.

    Messages without a schema part have NULL there.
    """
    message = schemas.either_envelope(schemas.change_body(_row(table, columns)))
    decoded = _decode(
        records, message, F.col("timestamp").alias("kafka_timestamp"), "partition", "offset"
    )
    return decoded.select(
        "kafka_timestamp",
        "partition",
        "offset",
        F.col("schema.name").alias("schema_name"),
        F.col("schema.version").alias("schema_version"),
        _either("op").alias("operation"),
        _either("source.table").alias("table_name"),
        _either("source.ts_ms").alias("source_timestamp"),
        _either("before").alias("before_data"),
        _either("after").alias("after_data"),
    ).filter(F.col("operation").isNotNull())


def _may_hold(operations: Sequence[str]) -> Column:
    """Whether a message's text can carry one of ``operations``: quoted either way, or written with escapes."""
    text = F.col("value").cast("string")
    signs = [f'"{o}"' for o in operations] + ["\\"] + [f"'{o}'" for o in operations]
    return reduce(Column.__or__, [text.contains(s) for s in signs])


def changes(
    records: DataFrame, table: str, columns: Sequence[str] | None = None, operations: Sequence[str] | None = None
) -> DataFrame:
    """Flat changes of one table. Messages without an operation (tombstones, broken text, other
    content) are dropped. ``columns`` limits the row images to the columns a caller reads,
    ``operations`` (letters, as c, r, u, d) the changes to those kinds: a message that cannot be one,
    since its text nowhere names them, is dropped before it is parsed.
    """
    if operations is not None:
        records = records.filter(_may_hold(operations))
    flat = parse_wrapped_changes(records, table, columns).drop("schema_name", "schema_version")
    return flat if operations is None else flat.filter(F.col("operation").isin(*operations))


def evolved_changes(records: DataFrame, table: str = "customers") -> DataFrame:
    """Changes under the newer row type; columns an older message lacks are NULL."""
    return changes(records, f"{table}_evolved")


def parse_change_paths(records: DataFrame, typed: bool = False) -> DataFrame:
    """A customer message's operation, id and email as plain text; no row is dropped.

    With ``typed``: also names and source time, id and time as numbers (NULL where the text is no
    number), and messages without an operation dropped.
    """
    row = schemas.struct(
        "id string, first_name string, last_name string, email string"
        if typed
        else "id string, email string"
    )
    body = T.StructType([T.StructField("after", row), T.StructField("op", T.StringType())])
    if typed:
        body = body.add("source", schemas.struct("ts_ms string"))
    message = T.StructType(body.fields + [T.StructField("payload", body)])
    decoded = _decode(records, message, "timestamp")
    operation = _either("op").alias("operation")
    email = _either("after.email").alias("email")
    if not typed:
        return decoded.select(
            "timestamp", operation, _either("after.id").alias("customer_id"), email
        )
    return decoded.select(
        "timestamp",
        operation,
        _either("after.id").try_cast("bigint").alias("customer_id"),
        _either("after.first_name").alias("first_name"),
        _either("after.last_name").alias("last_name"),
        email,
        _either("source.ts_ms").try_cast("bigint").alias("source_timestamp"),
    ).filter(F.col("operation").isNotNull())


def topic_ops(records: DataFrame) -> DataFrame:
    """topic, timestamp, operation and table of any table's messages, decoding nothing else."""
    body = schemas.struct("source struct<table: string>, op string")
    message = T.StructType(body.fields + [T.StructField("payload", body)])
    return (
        _decode(records, message, "topic", "timestamp")
        .select(
            "topic",
            "timestamp",
            _either("op").alias("operation"),
            _either("source.table").alias("table_name"),
        )
        .filter(F.col("operation").isNotNull())
    )


def raw_images(records: DataFrame) -> DataFrame:
    """Changes of any table, with the row images left as JSON text."""
    message = schemas.change_body(T.StringType())
    message = T.StructType(message.fields + [T.StructField("payload", message)])
    return (
        _decode(
            records,
            message,
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
        )
        .select(
            "topic",
            "partition",
            "offset",
            "kafka_timestamp",
            _either("op").alias("operation"),
            _either("source.table").alias("table_name"),
            _either("source.ts_ms").alias("source_timestamp"),
            _either("before").alias("before_data"),
            _either("after").alias("after_data"),
        )
        .filter(F.col("operation").isNotNull())
    )


def message_metadata(records: DataFrame) -> DataFrame:
    """Where each message came from; the value stays binary and undecoded."""
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("message_key"),
        F.col("value").alias("avro_value"),
    )


def first_messages(records: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` first messages by position, for a look at the data."""
    return message_metadata(records).orderBy("topic", "partition", "offset").limit(n)
