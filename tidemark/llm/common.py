"""Shared small pieces: words, text mapping on executors, running sums, stored results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import scratch_dir

#: A word is a maximal run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut smaller, so that of their texts only few are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mapped(
    df: DataFrame,
    columns: Sequence[str],
    fn: Callable[..., Iterator[tuple] | Sequence[tuple]],
    ddl: str,
) -> DataFrame:
    """Rows ``fn(*values)`` of each row's ``columns``, in Arrow batches on the executors.

    ``fn`` gets the Python values of one row and gives any number of rows of the schema ``ddl``.
    Batches are bounded by Spark in rows and bytes; output is passed on in batches as well.
    """
    schema = T._parse_datatype_string(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows: list[tuple] = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                rows.extend(fn(*values))
                if len(rows) >= 8192:
                    yield _batch(rows, arrow)
                    rows = []
            if rows:
                yield _batch(rows, arrow)

    return df.select(*columns).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def cut_lineage(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder: its partitions stay as they are when read again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Its shuffle files go when the write has ended, so the steps of a long job do not add up on disk.
    """
    spark = df.sparkSession
    path, before = scratch_dir(spark, label), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, in which null equals null; keeps the keys of ``left``."""
    names = {k: f"same_{k}" for k in keys}
    found = F.lit(True)
    for k, other in names.items():
        found = found & F.col(k).eqNullSafe(F.col(other))
    return left.join(right.withColumnsRenamed(names), found).drop(*names.values())


def ranged(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` dealt out in ``order``, its partition number kept as ``part``; cuts the lineage.

    Dealing out by range reads its input twice, the first time for a sample of the order, so what
    makes the rows is run and checkpointed before.
    """
    return cut_lineage(cut_lineage(df).repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


def offsets(cut: DataFrame, amount: str, by: Sequence[str] = ()) -> DataFrame:
    """Per ``part`` and ``by``: the sum of ``amount`` in all earlier parts, as ``before``.

    The table has at most one row per partition and group, whatever the number of rows.
    """
    totals = cut.groupBy(*by, "part").agg(F.sum(amount).alias("subtotal"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("subtotal").over(earlier), F.lit(0)).cast("bigint")
    return totals.select(*by, "part", before.alias("before"))


def running(amount: str, order: Sequence[Column | str], by: Sequence[str] = ()) -> Column:
    """Running sum of ``amount`` within a part and group, itself included."""
    inside = Window.partitionBy("part", *by).orderBy(*order)
    return F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
