"""Sales, retention, quality, state and insight on small tables."""

import datetime as dt
import decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.skew import join_per_key
from tidemark.operators import insight, quality, retention, sales, state
from tidemark.plans import daily_sales, queries
from tidemark.plans.queries import all_queries
from tidemark.sources import tables

D = decimal.Decimal


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


@pytest.fixture
def raw(spark):
    data = [
        (1, 10, 2, D("5.00"), day(1)),
        (1, 11, 1, D("0.10"), day(1, 23)),
        (2, 10, 3, D("5.00"), day(2)),
        (2, 12, 1, D("7.77"), day(9, 5)),
        (3, 12, 1, D("1.00"), None),
    ]
    return spark.createDataFrame(data, schemas.struct(schemas.RAW_SALES))


def test_extract_takes_the_whole_day_only(raw):
    got = sales.extract_daily_sales(raw, "2024-01-01")
    assert [r["product_id"] for r in got.orderBy("product_id").collect()] == [10, 11]
    assert {r["sale_date"] for r in got.collect()} == {dt.date(2024, 1, 1)}
    wanted = schemas.struct(schemas.STAGING_SALES)
    assert got.schema.simpleString() == wanted.simpleString()
    assert sales.extract_daily_sales(raw, "2024-01-03").count() == 0


def test_extract_filter_reaches_the_scan(spark, raw, out):
    raw.write.parquet(out + "/raw")
    got = sales.extract_daily_sales(spark.read.parquet(out + "/raw"), "2024-01-01")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan and "LessThan(created_at" in plan


def test_metrics(raw):
    staging = sales.extract_daily_sales(raw)
    got = rows(sales.daily_metrics(staging))
    assert (dt.date(2024, 1, 1), 2, D("10.10"), 5.05, 1) in got and len(got) == 3
    one = rows(sales.daily_metrics(staging, "2024-01-02"))
    assert one == [(dt.date(2024, 1, 2), 1, D("15.00"), 15.0, 1)]


def test_retention_of_rows_goes_by_creation_time(raw):
    staging = sales.staging_sales(raw.withColumn("sale_date", F.lit(dt.date(2024, 1, 9))))
    kept = sales.retain_recent(staging, "2024-01-09", 7)
    assert rows(kept.select("customer_id")) == [(2,), (2,), (3,)]


def test_validation_finds_lost_and_misdated_rows(raw):
    staging = sales.extract_daily_sales(raw)
    found = {r["check_name"]: r["violations"] for r in quality.validate_extract(staging, raw).collect()}
    assert {k for k, v in found.items() if v} == {"undated rows"} and found["undated rows"] == 1
    bad = staging.filter("product_id <> 12").withColumn("sale_date", F.lit(dt.date(2024, 1, 1)))
    found = {r["check_name"]: r["violations"] for r in quality.validate_extract(bad, raw).collect()}
    assert (found["wrong day"], found["lost rows"], found["gained rows"]) == (1, 1, 0)


def test_validation_tells_lost_from_doubled_rows(raw):
    staging = sales.extract_daily_sales(raw)
    bad = staging.filter("product_id <> 11").unionByName(staging.filter("product_id = 12"))
    found = {r["check_name"]: r["violations"] for r in quality.validate_extract(bad, raw).collect()}
    assert {k: v for k, v in found.items() if v} == {"lost rows": 1, "gained rows": 1, "undated rows": 1}


def test_daily_run_repeats_without_doubling(spark, raw, out):
    for _ in range(2):
        report = daily_sales.run_day(spark, raw, out, "2024-01-01")
    assert rows(report) == [(dt.date(2024, 1, 1), 2, D("10.10"), 5.05, 1)]
    daily_sales.run_day(spark, raw, out, "2024-01-09")
    staged = tables.read_staging(spark, out + "/staging_sales")
    assert rows(staged.select("sale_date")) == [(dt.date(2024, 1, 9),)]
    assert rows(tables.read_metrics(spark, out + "/daily_metrics").select("sale_date")) == [
        (dt.date(2024, 1, 1),),
        (dt.date(2024, 1, 9),),
    ]
    archived = spark.read.parquet(out + "/archive/2024-01-09")
    assert archived.count() == 2


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_single_days_keep_the_others_at_any_grain(spark, raw, out, grain):
    for n in (1, 2, 2):
        report = daily_sales.run_day(spark, raw, out, dt.date(2024, 1, n), grain=grain)
    assert [r["sale_date"].day for r in report.collect()] == [1, 2]
    assert tables.read_staging(spark, out + "/staging_sales").count() == 3
    none = raw.filter("customer_id <> 2")
    report = daily_sales.run_day(spark, none, out, "2024-01-02", grain=grain)
    assert [r["sale_date"].day for r in report.collect()] == [1]
    assert tables.read_staging(spark, out + "/staging_sales").count() == 2
    report = daily_sales.run_day(spark, raw, out, "2024-01-09", grain=grain)
    assert [r["sale_date"].day for r in report.collect()] == [1, 9]
    staged = tables.read_staging(spark, out + "/staging_sales")
    assert rows(staged.select("sale_date")) == [(dt.date(2024, 1, 9),)]


def test_cleanup_drops_periods_without_reading_them(spark, raw, out):
    tables.append_staging(sales.extract_daily_sales(raw), out + "/s", "day")
    assert len(tables.periods(spark, out + "/s")) == 3
    tables.drop_before(spark, out + "/s", schemas.STAGING_SALES, dt.date(2024, 1, 2))
    assert tables.periods(spark, out + "/s") == [dt.date(2024, 1, 2), dt.date(2024, 1, 9)]


def test_gate_stops_the_run(spark, raw, out):
    with pytest.raises(ValueError, match="too few records: 2"):
        daily_sales.run_day(spark, raw, out, "2024-01-01", minimum=3)
    assert not Path(out, "daily_metrics").exists()


def test_coarser_grain_replaces_its_periods(spark, raw, out):
    staging = sales.extract_daily_sales(raw)
    for _ in range(2):
        tables.append_staging(staging, out + "/s", "month")
    assert rows(tables.read_staging(spark, out + "/s")) == rows(staging)


def test_a_large_day_is_written_by_several_tasks(spark, out):
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    hot = F.when(F.col("id") % 100 > 0, dt.date(2024, 1, 1)).otherwise(dt.date(2024, 1, 2))
    rows_in = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("int").alias("customer_id"),
        F.hash("id").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.lit(day(1)).alias("created_at"),
        hot.alias("sale_date"),
    )
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        tables.append_staging(rows_in, f"{out}/s")
    finally:
        for key in sizes:
            spark.conf.unset(key)
    files = [len(list(Path(f"{out}/s").glob(f"version=*/sale_date=2024-01-0{d}/*.parquet"))) for d in (1, 2)]
    assert files[0] > 1 and files[1] == 1
    assert tables.read_staging(spark, f"{out}/s").count() == 200_000


def test_staging_table_in_the_catalog(spark, raw, out):
    tables.create_staging(spark, "staging_once", out + "/t")
    tables.create_staging(spark, "staging_once", out + "/t")
    staging = sales.extract_daily_sales(raw)
    staging.write.insertInto("staging_once")
    assert tables.table(spark, "staging_once").count() == 4
    columns = "customer_id, product_id, quantity, price, sale_date"
    spark.sql(f"INSERT INTO staging_once ({columns}) VALUES (9, 9, 1, 1.00, DATE '2024-02-01')")
    assert spark.sql("SELECT created_at FROM staging_once WHERE customer_id = 9").first()[0] is not None
    spark.sql("DROP TABLE staging_once")


def test_cohorts(spark):
    data = [
        ("a", day(1), day(1)),
        ("a", day(1), day(3)),
        ("a", day(1), day(3, 9)),
        ("b", day(1, 5), day(3)),
        ("c", day(5), day(4)),
        ("d", day(1), day(1) - dt.timedelta(days=2)),
    ]
    activity = spark.createDataFrame(data, "user_id string, signup_time timestamp, activity_time timestamp")
    first = dt.date(2024, 1, 1)
    assert rows(retention.cohort_sizes(activity)) == [(first, 3), (dt.date(2024, 1, 5), 1)]
    assert [tuple(r) for r in retention.cohort_retention(activity).collect()] == [
        (first, 0, 1, 3, 1 / 3),
        (first, 2, 2, 3, 2 / 3),
    ]


def test_source_totals_and_gate(spark):
    totals = quality.source_totals(
        {"file": spark.range(70), "api": spark.range(30), "none": spark.range(0)}
    )
    assert tuple(totals.first()) == (100, ["api", "file"])
    assert quality.enforce(quality.row_count_gate(totals)) == 100
    with pytest.raises(ValueError, match="too few"):
        quality.enforce(quality.row_count_gate(totals, 101))


# Sample orders (id, total) and order items (order, product, quantity, unit price).
ORDERS = [
    (1, "1329.98"),
    (2, "89.99"),
    (3, "224.98"),
    (4, "159.98"),
    (5, "24.99"),
    (6, "119.98"),
    (7, "19.99"),
    (8, "104.98"),
    (9, "129.99"),
    (10, "249.98"),
]
ITEMS = [
    (1, 1, 1, "1299.99"),
    (1, 2, 1, "29.99"),
    (2, 4, 1, "89.99"),
    (3, 3, 1, "199.99"),
    (3, 5, 1, "24.99"),
    (4, 6, 1, "39.99"),
    (4, 9, 1, "79.99"),
    (5, 5, 1, "24.99"),
    (6, 2, 1, "29.99"),
    (6, 6, 1, "39.99"),
    (6, 8, 1, "24.99"),
    (7, 7, 1, "19.99"),
    (8, 8, 1, "24.99"),
    (8, 9, 1, "79.99"),
    (9, 10, 1, "129.99"),
    (10, 1, 1, "1299.99"),
    (10, 6, 1, "39.99"),
]


@pytest.fixture
def stored(spark):
    orders = spark.createDataFrame(
        [(i, i, D(t)) for i, t in ORDERS], "id int, customer_id int, total_amount decimal(10,2)"
    )
    items = spark.createDataFrame(
        [(n, o, p, q, D(u)) for n, (o, p, q, u) in enumerate(ITEMS)],
        "id int, order_id int, product_id int, quantity int, unit_price decimal(10,2)",
    )
    return {"orders": orders, "order_items": items}


def test_reconciliation_of_the_sample_orders(stored):
    wrong = quality.reconcile_order_totals(stored["orders"], stored["order_items"])
    assert [r["order_id"] for r in wrong.orderBy("order_id").collect()] == [4, 6, 10]
    every = quality.reconcile_order_totals(stored["orders"], stored["order_items"], False)
    assert every.count() == 10
    nothing = stored["order_items"].filter("false")
    assert quality.reconcile_order_totals(stored["orders"], nothing).count() == 10


def test_constraints(spark, stored):
    customers = spark.createDataFrame(
        [(1, "A", "B", "x"), (2, None, "B", "x"), (2, "A", "B", None), (3, "A", "B", None)],
        "id int, first_name string, last_name string, email string",
    )
    addresses = spark.createDataFrame(
        [(1, 1, "S", "C", "N"), (2, 99, "S", None, "N"), (3, None, "S", "C", "N")],
        "id int, customer_id int, street_address string, city string, country string",
    )
    report = quality.constraint_report({"customers": customers, "addresses": addresses, **stored})
    found = {tuple(r)[:3]: r["violations"] for r in report.collect() if r["violations"]}
    assert found == {
        ("customers", "not null", "first_name"): 1,
        ("customers", "not null", "email"): 2,
        ("customers", "unique", "id"): 1,
        ("customers", "unique", "email"): 1,
        ("addresses", "not null", "city"): 1,
        ("addresses", "foreign key", "customer_id"): 1,
        ("orders", "foreign key", "customer_id"): 7,
    }


CHANGES = (
    "source_timestamp bigint, offset bigint, operation string, "
    "before_data struct<id: int, v: string>, after_data struct<id: int, v: string>"
)


def test_current_state(spark):
    data = [
        (10, 1, "c", None, (1, "a")),
        (20, 3, "u", (1, "a"), (1, "late in time")),
        (15, 9, "u", (1, "a"), (1, "b")),
        (20, 2, "u", (1, "b"), (1, "c")),
        (5, 4, "c", None, (2, "x")),
        (6, 5, "d", (2, "x"), None),
        (7, 6, "d", (3, "x"), None),
        (8, 7, "c", None, (3, "again")),
        (None, 8, "r", None, (4, "no time")),
    ]
    df = spark.createDataFrame(data, CHANGES)
    want = [(1, "late in time"), (3, "again"), (4, "no time")]
    assert rows(state.current_state(df)) == want
    early = df.filter("offset <= 5 or offset is null")
    merged = state.merge_latest(state.latest_changes(early), df.filter("offset > 5"))
    assert rows(state.live_rows(merged)) == want


def test_enrichment_keeps_unknown_customers(spark):
    image = "struct<id: int, customer_id: int, total_amount: decimal(10,2), status: string>"
    changes = spark.createDataFrame(
        [("c", 1, None, (1, 7, D("1.00"), "P")), ("d", 2, (2, 8, D("2.00"), "S"), None)],
        f"operation string, source_timestamp bigint, before_data {image}, after_data {image}",
    )
    customers = spark.createDataFrame(
        [(7, "A", "B", "e")], "id int, first_name string, last_name string, email string"
    )
    got = insight.enrich_changes(changes, customers).orderBy("order_id")
    assert [(r["order_id"], r["operation"], r["email"]) for r in got.collect()] == [
        (1, "c", "e"),
        (2, "d", None),
    ]


@pytest.mark.parametrize("key_rows,hot_share", [(0, 1), (0, 10), (0, 1000), (4, 1000), (5, 1000), (99, 1000)])
def test_join_per_key_with_hot_keys_and_keys_just_below(spark, key_rows, hot_share):
    facts = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k")
    )
    facts = facts.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS BIGINT) AS k"))
    per_key = facts.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    per_key = per_key.filter("n > 4")
    want = facts.join(per_key, "k").select("id", "k", "n", "low")
    assert rows(join_per_key(facts, per_key, "k", "n", key_rows, hot_share)) == rows(want)


def test_anomalies(spark):
    usual = [(i, 1, D(10 + i % 2)) for i in range(20)] + [(99, 1, D(100))]
    few = [(200 + i, 2, D(10)) for i in range(3)] + [(299, 2, D(1000))]
    orders = spark.createDataFrame(
        usual + few, "id int, customer_id int, total_amount decimal(10,2)"
    )
    got = insight.transaction_anomalies(orders)
    assert [(r["order_id"], r["order_count"]) for r in got.collect()] == [(99, 21)]


def test_constraints_read_typed_columns(spark, out):
    for name, ddl in (("a", "id bigint, email string"), ("b", "id bigint, customer_id bigint")):
        spark.createDataFrame([(1, "1"), (2, None)], "x bigint, y string").selectExpr(
            *[f"CAST({c} AS {f.split()[1]}) AS {f.split()[0]}" for c, f in zip("xy", ddl.split(", "))]
        ).write.parquet(f"{out}/{name}")
    customers = spark.read.parquet(f"{out}/a").withColumns({"first_name": F.lit("f"), "last_name": F.lit("l")})
    orders = spark.read.parquet(f"{out}/b").withColumn("total_amount", F.lit(1))
    report = quality.constraint_report({"customers": customers, "orders": orders})
    found = {tuple(r)[:3]: r["violations"] for r in report.collect()}
    assert {k for k, v in found.items() if v} == {("customers", "not null", "email")} and len(found) == 10
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReadSchema: struct<id:bigint>") >= 2 and "NestedLoop" not in plan


def test_activity_change(spark):
    days = [1, 2, 2, 3, 5, 5]
    events = spark.createDataFrame([(1, day(d)) for d in days], "user_id int, ts timestamp")
    got = insight.customer_activity_change(events, "day").orderBy("period_start").collect()
    assert [(r["event_count"], r["previous_count"], r["difference"]) for r in got] == [
        (1, 0, 1),
        (2, 1, 1),
        (1, 2, -1),
        (0, 1, -1),
        (2, 0, 2),
    ]


def test_drift_parses_each_message_once(spark):
    """Neither a filter of tables nor the spreading of fields parses the messages again, and a small file is dealt out."""
    plan = all_queries()["schema_drift"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    assert not [line for line in lines if "Filter" in line.split("(")[0] and "parseJson" in line]
    # Between the join of fields and the scans, only dealing out and single evaluations are left.
    assert sum("RepartitionByExpression" in line for line in lines) == 2


def test_runs_read_the_joined_sales_as_stored(spark, monkeypatch):
    """Orders and items are joined once for all runs; no step of a run joins, and so shuffles, them again."""
    class Seen(Exception):
        pass

    def run_day(spark, raw, *_, **__):
        raise Seen(raw._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(daily_sales, "run_day", run_day)
    with pytest.raises(Seen) as seen:
        all_queries()["daily_sales_run"](spark, "/root/testdata/sf0.001")
    assert "Join" not in str(seen.value) and "Relation" in str(seen.value)


@pytest.mark.parametrize("name", ["compacted_change_log", "change_log", "change_stream", "enrich_change_stream", "late_changes"])
def test_arrivals_are_dealt_out(spark, monkeypatch, name):
    """No arrival's messages are made, and so written and parsed, by the one task that reads a small file."""
    class Seen(Exception):
        pass

    def replayed(spark, label, arrivals, *_, **__):
        raise Seen([a._jdf.queryExecution().optimizedPlan().toString() for a in arrivals])

    monkeypatch.setattr(queries, "_replayed", replayed)
    with pytest.raises(Seen) as seen:
        all_queries()[name](spark, "/root/testdata/sf0.001")
    assert all(p.count("RepartitionByExpression") == p.count("Relation [") > 0 for p in seen.value.args[0])
