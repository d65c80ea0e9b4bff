"""Hand-written messages: both envelopes, tombstones, broken text, odd values."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes as ch
from tidemark.operators import insight, parse, state

NOON = dt.datetime(2024, 1, 1, 12)


def records(spark, values, topic="shop.sales.customers"):
    rows = [
        (b'{"id":%d}' % i, None if v is None else v.encode(), topic, 0, i, NOON, 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, schemas.struct(schemas.RECORD))


def message(op, before=None, after=None, wrapped=False, table="customers", version=1):
    body = {
        "before": before,
        "after": after,
        "source": {"table": table, "ts_ms": 1704067201999},
        "op": op,
    }
    if wrapped:
        described = {"type": "struct", "fields": [{"field": "op"}], "name": "S", "version": version}
        body = {"schema": described, "payload": body}
    return json.dumps(body)


def customer(i, email="a@x", **more):
    return {"id": i, "first_name": "F", "last_name": "L", "email": email, **more}


def product(i, price, stock, name="P"):
    return {"id": i, "name": name, "price": price, "quantity_in_stock": stock}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_both_envelopes_give_the_same_changes(spark):
    pair = [message("u", customer(1), customer(1, "b@x"), wrapped=w) for w in (False, True)]
    got = parse.changes(records(spark, pair), "customers").drop("offset").collect()
    assert got[0] == got[1]
    assert got[0]["operation"] == "u"
    assert got[0]["table_name"] == "customers"
    assert got[0]["source_timestamp"] == 1704067201999
    assert (got[0]["before_data"]["email"], got[0]["after_data"]["email"]) == ("a@x", "b@x")


def test_messages_without_an_operation_are_dropped(spark):
    broken = [None, "", "{bad", "null", "[]", "7", '{"schema":{}}']
    df = records(spark, [*broken, message("c", None, customer(9))])
    assert [r["after_data"]["id"] for r in parse.changes(df, "customers").collect()] == [9]
    assert rows(parse.topic_ops(df).select("operation")) == [("c",)]
    assert parse.raw_images(df).count() == 1
    assert parse.parse_change_paths(df, typed=True).count() == 1
    assert parse.parse_change_paths(df).count() == len(broken) + 1
    assert parse.parse_changes(df, "customers").count() == len(broken) + 1


def test_full_message_keeps_key_time_and_origin(spark):
    body = json.loads(message("c", None, customer(1, created_at=5)))
    body["source"] |= {"version": "2.4", "txId": 7, "lsn": 8, "snapshot": "false", "db": "shop"}
    body |= {"ts_ms": 99, "transaction": None}
    got = parse.parse_changes(records(spark, [json.dumps(body)]), "customers").first()
    assert got["message_key"] == '{"id":0}'
    assert got["timestamp"] == NOON
    source = got["data"]["source"]
    assert (source["version"], source["txId"], source["lsn"], source["db"]) == ("2.4", 7, 8, "shop")
    assert (got["data"]["ts_ms"], got["data"]["before"]) == (99, None)
    assert got["data"]["after"]["created_at"] == 5


def test_schema_versions(spark):
    df = records(
        spark,
        [
            message("c", None, customer(1), wrapped=True),
            message("c", None, customer(2), wrapped=True),
            message("c", None, customer(3), wrapped=True, version=2),
            message("c", None, customer(4)),
        ],
    )
    parsed = parse.parse_wrapped_changes(df, "customers")
    assert rows(ch.schema_versions(parsed)) == [("S", 1), ("S", 2), (None, None)]


def test_paths_as_text_and_typed(spark):
    df = records(
        spark,
        [
            message("c", None, customer(1)),
            message("c", None, {**customer(2), "id": "abc"}),
            message("d", customer(3), None),
            message("u", customer(4), customer(4, "n@x"), wrapped=True),
        ],
    )
    plain = parse.parse_change_paths(df).select("operation", "customer_id", "email")
    assert rows(plain) == sorted(
        [("c", "1", "a@x"), ("c", "abc", "a@x"), ("d", None, None), ("u", "4", "n@x")], key=repr
    )
    typed = parse.parse_change_paths(df, typed=True)
    assert typed.schema["customer_id"].dataType.simpleString() == "bigint"
    assert [r["customer_id"] for r in typed.collect()] == [1, None, None, 4]
    assert {r["source_timestamp"] for r in typed.collect()} == {1704067201999}


@pytest.mark.parametrize(
    "given, expected",
    [(12.3, "12.30"), ("12.30", "12.30"), (12.345, "12.35"), ("Afu7", None), (None, None)],
)
def test_prices(spark, given, expected):
    df = records(spark, [message("c", None, product(1, given, 1), table="products")])
    price = parse.changes(df, "products").first()["after_data"]["price"]
    assert price == (None if expected is None else decimal.Decimal(expected))


def test_alerts_need_both_sides(spark):
    updates = [
        (product(1, 10, 5), product(1, 11, 5)),
        (product(2, None, None), product(2, 11, 5)),
        (product(3, 10, 5), product(3, None, None)),
        (product(4, 10, 12), product(4, 10, 9)),
        (product(5, "x", 10), product(5, 10, 10)),
        (product(6, 10, 9), product(6, 10, 8)),
    ]
    df = records(spark, [message("u", b, a, table="products") for b, a in updates])
    parsed = parse.changes(df, "products", ["id", "name", "price", "quantity_in_stock"])
    d = decimal.Decimal
    assert rows(ch.price_changes(parsed)) == [(1, "P", d("10.00"), d("11.00"))]
    assert rows(ch.stock_changes(parsed)) == [(4, "P", 12, 9, -3), (6, "P", 9, 8, -1)]
    assert rows(insight.restock_alerts(parsed)) == [(4, "P", 12, 9, -3)]


def test_branches_and_unknown_operation(spark):
    df = records(
        spark,
        [
            message("c", None, customer(1)),
            message("r", None, customer(2), wrapped=True),
            message("u", customer(3), customer(3)),
            message("u", customer(4), customer(4, "new@x")),
            message("u", customer(5, None), customer(5, "new@x")),
            message("d", customer(6), None),
            message("t"),
        ],
    )
    parsed = parse.changes(df, "customers")
    assert rows(ch.op_counts(parsed)) == [("c", 1), ("d", 1), ("r", 1), ("t", 1), ("u", 3)]
    assert rows(ch.history_op_counts(parsed))[-1] == (None, 7)
    assert [r["id"] for r in ch.inserted_rows(parsed).orderBy("id").collect()] == [1, 2]
    assert [r["id"] for r in ch.deleted_rows(parsed).collect()] == [6]
    assert ch.updated_emails(parsed).count() == 3
    timed = ch.updated_emails_timed(parsed)
    assert {r["change_time"] for r in timed.collect()} == {"2024-01-01 00:00:01"}
    assert rows(ch.email_changes(parsed)) == [(4, "F", "L", "a@x", "new@x")]
    assert rows(ch.batch_volume(parsed)) == [(7,)]
    assert rows(ch.batch_volume(parsed.filter("false"))) == [(0,)]


def test_evolved_rows_fill_missing_columns_with_null(spark):
    old, new = customer(1), customer(2, phone="555")
    df = records(spark, [message("c", None, old), message("c", None, new, wrapped=True)])
    got = parse.evolved_changes(df).select("after_data.id", "after_data.phone")
    assert rows(got) == [(1, None), (2, "555")]
    assert "phone" not in parse.changes(df, "customers").schema["after_data"].dataType.names


def test_metadata_leaves_the_value_alone(spark):
    raw = bytes([0, 0, 0, 0, 1, 255, 254])
    df = records(spark, ["x", "y", "z"]).withColumn("value", F.lit(bytearray(raw)))
    got = parse.message_metadata(df).orderBy("offset").first()
    assert bytes(got["avro_value"]) == raw
    assert (got["topic"], got["partition"], got["offset"]) == ("shop.sales.customers", 0, 0)
    assert [r["offset"] for r in parse.first_messages(df, 2).collect()] == [0, 1]


def test_each_message_is_parsed_once(spark):
    df = records(spark, [message("u", customer(1), customer(1, "b"))])
    for plan in (
        ch.email_changes(parse.changes(df, "customers")),
        parse.topic_ops(df),
        parse.parse_change_paths(df, typed=True),
    ):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json") == 1


def test_large_ids_and_changes_that_name_no_row(spark):
    """Ids beyond 32 bits stay apart; truncations and keyless changes are set aside and counted."""
    ids = (3_000_000_000, 3_000_000_001, None)
    bodies = [{"op": "c", "after": {"id": i, "first_name": f"n{i}"}, "source": {"ts_ms": 1}} for i in ids]
    bodies.append({"op": "t", "source": {"ts_ms": 2}})
    data = [(None, json.dumps(b).encode(), "x", 0, n, None, 0) for n, b in enumerate(bodies)]
    arrived = spark.createDataFrame(data, schemas.struct(schemas.RECORD))
    changes = parse.changes(arrived, "customers")
    live = state.current_state(changes).select("id", "first_name")
    assert sorted(map(tuple, live.collect())) == [(i, f"n{i}") for i in ids[:2]]
    assert sorted(map(tuple, state.set_aside(changes).collect())) == [("c", 1), ("t", 1)]


def test_changes_of_some_operations_are_told_before_parsing(spark):
    """Escaped and single-quoted operations count; what cannot be one of them never reaches the parser."""
    bodies = [message(op, after=customer(i), wrapped=w) for w in (False, True) for i, op in enumerate("crud")]
    escaped = message("c", after=customer(7)).replace('"op": "c"', '"op": "\\u0063"')
    single = message("r", after=customer(8)).replace('"op": "r"', "'op': 'r'")
    named = message("d", before=customer(9, "c"))
    found = records(spark, [*bodies, escaped, single, named, message("c", after=customer(10, "d")), None, "c", "{"])
    for operations in (["c"], ["c", "r"], ["d"], ["x"]):
        want = parse.changes(found, "customers").filter(F.col("operation").isin(*operations))
        assert rows(parse.changes(found, "customers", operations=operations)) == rows(want)
    assert {r.after_data.id for r in parse.changes(found, "customers", ["id"], ["c", "r"]).collect()} == {0, 1, 7, 8, 10}
    plan = parse.changes(found, "customers", ["id"], ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan.split("Generate")[1]
