"""Data quality: source totals, row-count gate, reconciliation, declared constraints."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

# Constraints of the captured tables. Every primary key is NOT NULL and unique.
NOT_NULL = {
    "customers": ["id", "first_name", "last_name", "email"],
    "products": ["id", "name", "price"],
    "orders": ["id", "total_amount"],
    "order_items": ["id", "quantity", "unit_price"],
    "addresses": ["id", "street_address", "city", "country"],
}
UNIQUE = {
    "customers": ["id", "email"],
    "products": ["id"],
    "orders": ["id"],
    "order_items": ["id"],
    "addresses": ["id"],
}
FOREIGN_KEYS = {
    "orders": {"customer_id": "customers"},
    "order_items": {"order_id": "orders", "product_id": "products"},
    "addresses": {"customer_id": "customers"},
}


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def source_totals(sources: dict[str, DataFrame]) -> DataFrame:
    """Total rows over all sources and the sorted names of those that have any."""
    counts = _stack(
        [
            df.agg(F.count(F.lit(1)).alias("records")).withColumn("source", F.lit(name))
            for name, df in sources.items()
        ]
    )
    contributing = F.when(F.col("records") > 0, F.col("source"))
    return counts.agg(
        F.sum("records").alias("total_records"),
        F.sort_array(F.collect_set(contributing)).alias("sources"),
    )


def row_count_gate(totals: DataFrame, minimum: int = 100) -> DataFrame:
    """total_records and whether it reaches ``minimum``."""
    return totals.select("total_records", (F.col("total_records") >= minimum).alias("passed"))


def enforce(gate: DataFrame) -> int:
    """The total of a passed gate; ValueError for a failed one. Reads the gate's single row."""
    row = gate.first()
    if not row["passed"]:
        raise ValueError(f"too few records: {row['total_records']}")
    return row["total_records"]


def reconcile_order_totals(
    orders: DataFrame, order_items: DataFrame, mismatched_only: bool = True
) -> DataFrame:
    """Stored order total against the sum over its items.

    Items are summed before the join, so both sides have one row per order. An order without items
    counts as zero.
    """
    lines = order_items.groupBy(F.col("order_id").alias("id")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(20,2)").alias("line_total")
    )
    compared = orders.join(lines, "id", "left").select(
        F.col("id").alias("order_id"),
        "total_amount",
        F.coalesce("line_total", F.lit(0)).cast("decimal(20,2)").alias("line_total"),
    )
    compared = compared.withColumn(
        "difference", (F.col("total_amount") - F.col("line_total")).cast("decimal(20,2)")
    )
    if not mismatched_only:
        return compared
    return compared.filter(~F.col("total_amount").eqNullSafe(F.col("line_total")))


def declared(names: Collection[str]) -> list[tuple[str, str, str]]:
    """(table, rule, column) of every constraint that the tables given allow to check."""
    out = []
    for name in names:
        out += [(name, "not null", c) for c in NOT_NULL[name]]
        out += [(name, "unique", c) for c in UNIQUE[name]]
        out += [(name, "foreign key", c) for c, p in FOREIGN_KEYS.get(name, {}).items() if p in names]
    return out


def _counted(df: DataFrame, column: str) -> DataFrame:
    """value and n of the values of a column, folded per task before the shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rule, column_name and violations for every declared constraint of the tables
    given. A foreign key is checked when its parent is given too.

    Missing values are found in one pass over a table, unique columns are counted per value in their
    own type. References are folded to their distinct values first, so one held by very many rows is one
    row, and meet the distinct ids of the parent by an anti join. What breaks a rule is summed once, for all
    rules together.
    """
    rules = declared(tables)
    number = {rule: i for i, rule in enumerate(rules)}
    found = []
    for name, df in tables.items():
        wanted = [(i, column) for (t, rule, column), i in number.items() if t == name and rule == "not null"]
        missing = F.array(*[F.when(F.col(column).isNull(), F.lit(i)) for i, column in wanted])
        found.append(df.select(F.explode(F.array_compact(missing)).alias("i"), F.lit(1).cast("bigint").alias("n")))
    for (name, rule, column), i in number.items():
        counted = _counted(tables[name], column)
        if rule == "unique":
            found.append(counted.filter("n > 1").select(F.lit(i).alias("i"), F.col("n") - 1))
        elif rule == "foreign key":
            parents = _counted(tables[FOREIGN_KEYS[name][column]], "id").select("value")
            found.append(counted.join(parents, "value", "left_anti").select(F.lit(i).alias("i"), "n"))
    broken = reduce(DataFrame.union, found).groupBy("i").agg(F.sum("n").alias("violations"))
    every = tables[rules[0][0]].sparkSession.createDataFrame(
        [(i, *rule) for rule, i in number.items()], "i int, table_name string, rule string, column_name string"
    )
    violations = F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    return every.join(F.broadcast(broken), "i", "left").select("table_name", "rule", "column_name", violations)


#: Groups in which extracted and raw sales are first compared.
GROUPS = 4096

SALE = ("customer_id", "product_id", "quantity", "price", "created_at")


def validate_extract(
    staging: DataFrame, raw: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """check_name and violations for extracted sales: missing values, rows stamped with another day
    than their own, rows lost and rows gained against the raw sales of the day (or of all days), and
    raw sales that no day can be given to.

    Both sides are first compared by the number and a checksum of the sales in each of ``GROUPS`` groups by
    hash, which are folded per task. Only sales of groups that differ are counted one by one, so that
    one lost and one doubled row are two violations; of a sound extract none is. The checksum adds up 64 bits of
    each sale.
    """
    created = F.col("created_at")
    if as_of is not None:
        day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        start = F.lit(day.isoformat()).cast("timestamp")
        end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp")
        raw = raw.filter((created >= start) & (created < end))
        staging = staging.filter(F.col("sale_date") == F.lit(day))
    columns = ["customer_id", "product_id", "quantity", "price", "sale_date"]
    wrong_day = ~F.col("sale_date").eqNullSafe(F.to_date("created_at"))
    faults = {f"missing {c}": F.col(c).isNull() for c in columns} | {"wrong day": wrong_day}
    hashed = F.xxhash64(*SALE).alias("hash")
    own = staging.select(*SALE, F.lit(1).alias("side"), hashed, *[v.cast("int").alias(n) for n, v in faults.items()])
    other = raw.select(*SALE, F.lit(-1).alias("side"), hashed, *[F.lit(0).alias(n) for n in faults])
    sides = own.unionByName(other).withColumn("part", F.pmod("hash", F.lit(GROUPS)))
    half = {"low": F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), "high": F.shiftright("hash", 32)}
    groups = sides.groupBy("part").agg(
        F.sum("side").alias("n"),
        *[F.sum(F.col("side") * v).alias(n) for n, v in half.items()],
        *[F.sum(n).alias(n) for n in faults],
    )
    groups = stored(groups, "compared")
    differing = groups.filter("n <> 0 OR low <> 0 OR high <> 0").select("part")
    unequal = sides.limit(0) if differing.isEmpty() else sides.join(F.broadcast(differing), "part", "left_semi")

    surplus, dated = F.col("surplus"), created.isNotNull()
    lost = {
        "lost rows": F.when(dated & (surplus < 0), -surplus),
        "gained rows": F.when(surplus > 0, surplus),
        "undated rows": F.when(~dated & (surplus < 0), -surplus if as_of is None else F.lit(0)),
    }
    per_sale = unequal.groupBy(*SALE).agg(F.sum("side").alias("surplus"))
    totals = [
        df.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias(n) for n, v in sums.items()]).unpivot(
            [], list(sums), "check_name", "violations"
        )
        for df, sums in ((groups, {n: F.col(n) for n in faults}), (per_sale, lost))
    ]
    return _stack(totals)
