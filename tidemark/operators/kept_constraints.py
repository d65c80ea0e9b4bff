"""Declared constraints kept up to date from changes, without reading the tables again.

Before- and after-images say which values a change takes away and which it brings. Counted with a sign
per rule and value, they are added to kept counts (``sources.state_table``), of which only the buckets of
changed values are rewritten. What breaks a rule follows from the counts alone: values of a unique column
that more than one row has, missing values, references to ids that no row has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import FOREIGN_KEYS, declared

COUNTS = "row_key string, n bigint"


def signed_values(changes: dict[str, DataFrame]) -> DataFrame:
    """row_key (rule and value) and n: by how much the changes of some tables raise or lower each count.

    Only missing values are counted of columns that must not be NULL. Values are folded per task first.
    """
    frames = []
    for table, df in changes.items():
        named = F.coalesce(F.col("operation").isin("c", "r", "u", "d"), F.lit(False))
        sides = F.array(
            F.struct(F.lit(1).alias("sign"), F.when(F.col("operation") != "d", F.col("after_data")).alias("image")),
            F.struct(F.lit(-1).alias("sign"), F.when(F.col("operation").isin("u", "d"), F.col("before_data")).alias("image")),
        )
        images = df.filter(named).select(F.inline(sides)).filter("image IS NOT NULL")
        values = []
        for _, rule, column in declared([table]):
            value = F.col(f"image.{column}")
            wanted = value.isNull() if rule == "not null" else value.isNotNull()
            shown = F.lit("") if rule == "not null" else value.cast("string")
            values.append(F.when(wanted, F.concat(F.lit(f"{table}/{rule}/{column}/"), shown)))
        for column in FOREIGN_KEYS.get(table, {}):
            value = F.col(f"image.{column}")
            values.append(F.when(value.isNotNull(), F.concat(F.lit(f"{table}/foreign key/{column}/"), value.cast("string"))))
        frames.append(images.select(F.explode(F.array_compact(F.array(*values))).alias("row_key"), "sign"))
    every = reduce(DataFrame.union, frames)
    return every.groupBy("row_key").agg(F.sum("sign").alias("n")).filter("n <> 0")


def added(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of both together."""
    met = kept.withColumnRenamed("n", "had").join(new.withColumnRenamed("n", "got"), "row_key", "full")
    return met.select("row_key", (F.coalesce("had", F.lit(0)) + F.coalesce("got", F.lit(0))).cast("bigint").alias("n"))


def report(counts: DataFrame, tables: list[str]) -> DataFrame:
    """As ``quality.constraint_report``, from kept counts of some tables."""
    parts = F.split("row_key", "/", 4)
    held = counts.filter("n > 0").select(
        *[parts[i].alias(c) for i, c in enumerate(("table_name", "rule", "column_name", "value"))], "n"
    )
    missing = held.filter("rule = 'not null'")
    repeated = held.filter("rule = 'unique' AND n > 1").withColumn("n", F.col("n") - 1)
    parents = [(t, c, p) for t in tables for c, p in FOREIGN_KEYS.get(t, {}).items() if p in tables]
    found = [missing.drop("value"), repeated.drop("value")]
    ids = held.filter("rule = 'unique' AND column_name = 'id'").select("value", F.col("table_name").alias("parent"))
    if parents:
        of = counts.sparkSession.createDataFrame(parents, "table_name string, column_name string, parent string")
        references = held.filter("rule = 'foreign key'").join(F.broadcast(of), ["table_name", "column_name"])
        found.append(references.join(ids, ["parent", "value"], "left_anti").select(*found[0].columns))
    keys = ["table_name", "rule", "column_name"]
    broken = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.sum("n").alias("violations"))
    every = counts.sparkSession.createDataFrame(declared(tables), "table_name string, rule string, column_name string")
    violations = F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")
    return every.join(F.broadcast(broken), keys, "left").select(*keys, violations)
