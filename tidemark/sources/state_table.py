"""The last change of every row as a kept table, of which an update rewrites only what it touches.

Rows lie in a fixed number of buckets by the hash of their key, as Spark's bucketed tables do, each
bucket in a folder of its own and each write of it in a version below: ``bucket=K/version=N``. The table
is registered in the catalog as bucketed by key, so a join with new changes moves the changes alone to
the buckets; what is kept is read where it lies. Only buckets that hold a changed key are read and
written. A snapshot (``sources.snapshots``) names the valid version of each bucket, so an update takes
effect at once or not at all, and repeating one changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import state
from tidemark.sources import snapshots

KEY = "row_key"


def _bucket(n: int) -> Column:
    """The bucket of a key, as Spark deals out bucketed tables."""
    return F.pmod(F.hash(KEY), F.lit(n))


def _registered(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> str:
    """Name of the bucketed table over ``path``, its folders as they are now."""
    files, folder = snapshots.place(spark, path)
    files.mkdirs(folder)
    name = "tidemark_state_" + hashlib.sha1(path.encode()).hexdigest()[:16]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, bucket INT, version BIGINT) USING parquet "
        f"PARTITIONED BY (bucket, version) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return name


def _kept(spark: SparkSession, name: str, now: snapshots.Snapshot, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a snapshot, or of some of its buckets."""
    wanted = now.folders if buckets is None else [f for b in buckets if (f := f"bucket={b}") in now.folders]
    pairs = [f"{f.removeprefix('bucket=')}/{now.folders[f][0]}" for f in wanted]
    valid = F.concat_ws("/", "bucket", "version").isin(pairs) if pairs else F.lit(False)
    return spark.table(name).filter(valid).drop("bucket", "version")


def merged(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Of two tables of last changes, the later one of each key; at equal positions that of ``new``."""
    later, earlier = (F.struct(f"{side}.source_timestamp", f"{side}.offset") for side in ("new", "kept"))
    whole = [F.struct(*[c for c in df.columns if c != KEY]).alias(side) for df, side in ((kept, "kept"), (new, "new"))]
    met = kept.select(KEY, whole[0]).join(new.select(KEY, whole[1]), KEY, "full")
    takes_new = F.col("new").isNotNull() & (F.col("kept").isNull() | (later >= earlier))
    return met.select(KEY, F.when(takes_new, F.col("new")).otherwise(F.col("kept")).alias("last")).select(KEY, "last.*")


def merge(changes: DataFrame, path: str, key: str = "id", buckets: int = 64) -> list[int]:
    """Bring a table of last changes up to date; gives the buckets that were written. A repeat changes nothing."""
    return update(state.latest_changes(changes, key), path, merged, buckets)


def update(
    new: DataFrame, path: str, combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, batch: int | None = None
) -> list[int]:
    """Bring a table of one row per key up to date with ``new``, of the same columns; gives the buckets written.

    ``combine(kept, new)`` joins the two on the key and gives all of their keys. Where a repeat would count
    twice, ``batch`` numbers the updates: one that is in already is passed over. ``buckets`` counts when
    the table is made: take it so that a bucket suits a task.
    """
    spark = new.sparkSession
    now = snapshots.latest(spark, path)
    if batch is not None and batch <= now.upto:
        return []
    n = now.buckets or buckets
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r[0] for r in new.select(_bucket(n)).distinct().collect())
        if now.number and not touched and batch is None:
            return []
        number = now.number + 1
        for bucket in touched:  # what a run that ended before its snapshot has left
            snapshots.delete(spark, f"{path}/bucket={bucket}/version={number}")
        name = _registered(spark, path, new.schema, n)
        known = [b for b in touched if f"bucket={b}" in now.folders]
        rows = combine(_kept(spark, name, now, known), new) if known else new.repartition(n, KEY)
        placed = rows.select(*new.columns, _bucket(n).alias("bucket"), F.lit(number).cast("bigint").alias("version"))
        placed.write.insertInto(name)
    finally:
        new.unpersist()
    folders = now.folders | {f"bucket={b}": [number] for b in touched}
    snapshots.publish(spark, path, snapshots.Snapshot(number, folders, now.upto if batch is None else batch, n))
    _tidy(spark, path, touched, [now.folders, folders])
    return touched


def _tidy(spark: SparkSession, path: str, buckets: list[int], valid: list[dict[str, list[int]]]) -> None:
    """Versions of the buckets that neither the snapshot nor the one before it names."""
    for bucket in buckets:
        folder = f"bucket={bucket}"
        named = {f"version={v}" for folders in valid for v in folders.get(folder, [])}
        for version in snapshots.names(spark, f"{path}/{folder}"):
            if version not in named:
                snapshots.delete(spark, f"{path}/{folder}/{version}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table kept by ``update``."""
    now = snapshots.latest(spark, path)
    if not now.number:
        return spark.createDataFrame([], schema)
    return _kept(spark, _registered(spark, path, schema, now.buckets), now)


def latest(spark: SparkSession, path: str, image: T.DataType) -> DataFrame:
    """The last change of every row, deletions included; ``image`` is the type of a row."""
    ddl = f"{KEY} bigint, source_timestamp bigint, offset bigint, operation string"
    return read(spark, path, T.StructType.fromDDL(ddl).add("image", image))


def live(spark: SparkSession, path: str, image: T.DataType) -> DataFrame:
    """The rows the table holds, those last deleted left out."""
    return state.live_rows(latest(spark, path, image))
