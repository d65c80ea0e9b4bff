"""Messages without a declared row type: any path of any table's messages, and what fields they really have.

A message is parsed once, into a variant; every path is then read from that. Where a declared row type
exists, the fields that were seen are set against it, so that a column added or retyped at the source
is noticed before it is read as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def _message() -> Column:
    return F.try_parse_json(F.decode("value", "UTF-8"))


def change_paths(records: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """timestamp and, per name, the value at a path such as ``after.id`` in a type, NULL where there is none
    or it does not fit; the payload of a wrapped message counts like a bare one. No row is dropped.
    """
    parsed = records.select("timestamp", _message().alias("message"))
    found = [
        F.coalesce(*[F.try_variant_get("message", f"$.{base}{path}", kind) for base in ("payload.", "")]).alias(name)
        for name, (path, kind) in paths.items()
    ]
    return parsed.select("timestamp", *found)


def seen_fields(records: DataFrame) -> DataFrame:
    """table_name, field, seen_type and changes: the fields of the after-images and the narrowest type that
    holds all values of each. Types are merged per task first; no message moves. The images are spread by an
    outer explode, since for a plain one the optimizer adds a filter that parses every message once more.
    """
    parsed = records.select(_message().alias("message"))
    bodies = [F.try_variant_get("message", path, "variant") for path in ("$.payload", "$")]
    body = parsed.select(F.coalesce(*bodies).alias("body"))
    image = body.select(
        F.try_variant_get("body", "$.source.table", "string").alias("table_name"),
        F.explode_outer(F.try_variant_get("body", "$.after", "map<string,variant>")).alias("field", "value"),
    )
    return image.filter(F.col("field").isNotNull()).groupBy("table_name", "field").agg(
        F.schema_of_variant_agg("value").alias("seen_type"), F.count(F.lit(1)).alias("changes")
    )


def schema_drift(seen: DataFrame, tables: list[str]) -> DataFrame:
    """The seen fields against the declared ones of some tables: ``status`` is declared, undeclared or unseen."""
    rows = [(t, f.name, f.dataType.simpleString()) for t in tables for f in schemas.row_schema(t).fields]
    declared = seen.sparkSession.createDataFrame(rows, "table_name string, field string, declared_type string")
    # Filtered behind the join, since before it the optimizer would parse every message once more for the filter.
    met = seen.join(F.broadcast(declared), ["table_name", "field"], "full").filter(F.col("table_name").isin(tables))
    status = F.when(F.col("declared_type").isNull(), "undeclared").when(F.col("seen_type").isNull(), "unseen")
    return met.select(
        "table_name",
        "field",
        "seen_type",
        "declared_type",
        F.coalesce("changes", F.lit(0)).cast("bigint").alias("changes"),
        status.otherwise("declared").alias("status"),
    )
