"""What a stream does with each micro-batch.

A micro-batch may be delivered again after a failure, so every sink writes to a place of its own that
a repeat overwrites: the folder ``batch_id=N`` of a result table. Batch numbers start anew with each
checkpoint, so an output belongs to the query that wrote it first; another one - a lost checkpoint, a
changed query - is refused instead of overwriting its results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import snapshots

Transform = Callable[[DataFrame], DataFrame]
BatchFunction = Callable[[DataFrame, int], None]

_FOLDED = "__folded"

#: Versions of a folded partition that are written as one.
_RUNS = 8


class OutputTaken(RuntimeError):
    """The output folder belongs to another query."""


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """N of the folders ``prefix=N`` below ``path``, in order."""
    files, place = snapshots.place(spark, path)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.removeprefix(f"{prefix}=")) for n in names if n.startswith(f"{prefix}="))


def claim(spark: SparkSession, path: str, query_id: str) -> None:
    """Make ``path`` the output of this query; OutputTaken if it is another's. The mark is a folder,
    whose creation is atomic and which readers pass over.
    """
    files, place = snapshots.place(spark, f"{path}/_queries")
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    if not names:
        files.mkdirs(snapshots.place(spark, f"{path}/_queries/{query_id}")[1])
        names = [s.getPath().getName() for s in files.listStatus(place)]
    if names != [query_id]:
        raise OutputTaken(f"{path} holds results of query {names[0]}; start {query_id} on a folder of its own")


def _for_output(write: BatchFunction, path: str) -> BatchFunction:
    write.output = path
    return write


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """The micro-batch, evaluated once for several reads.

    A second evaluation would parse every message again and, behind a windowed count, update the
    state store again. Kept rows may spill to disk and are rebuilt from the source if an executor is
    lost.
    """
    kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


_FINISHED = "_finished"


def _finished(spark: SparkSession, path: str) -> int | None:
    """The last batch that is written as a whole; None for a table without such marks."""
    done = [int(n) for n in snapshots.names(spark, f"{path}/{_FINISHED}")]
    return max(done, default=None)


@contextmanager
def _whole(spark: SparkSession, path: str, batch_id: int) -> Iterator[bool]:
    """Whether a batch is still to be written; marked afterwards as there for readers, in one step.

    Files become visible one by one as a write ends, over many folders where a table is partitioned;
    readers pass over batches behind the last mark, and a marked batch is not written again.
    """
    last = _finished(spark, path)
    if last is not None and batch_id <= last:
        yield False
        return
    yield True
    files, mark = snapshots.place(spark, f"{path}/{_FINISHED}/{batch_id}")
    files.mkdirs(mark)
    if last is not None:
        snapshots.delete(spark, f"{path}/{_FINISHED}/{last}")


def _skipped(kept: DataFrame, batch_id: int) -> bool:
    """Empty micro-batches write nothing, save the first, which leaves an empty table to read."""
    return batch_id > 0 and kept.isEmpty()


def batch_tables(results: dict[str, Transform], base: str) -> BatchFunction:
    """Write each named result of a micro-batch to ``base/<name>/batch_id=N``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch) as kept:
            if _skipped(kept, batch_id):
                return
            for name, transform in results.items():
                with _whole(batch.sparkSession, f"{base}/{name}", batch_id) as wanted:
                    if wanted:
                        _overwrite(transform(kept), f"{base}/{name}/batch_id={batch_id}")

    return _for_output(write, base)


def batch_table(path: str, transform: Transform | None = None) -> BatchFunction:
    """Write a micro-batch to ``path/batch_id=N``, transformed if asked for.

    With a ``transform`` the batch is kept meanwhile, since it may read its input twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        with _whole(batch.sparkSession, path, batch_id) as wanted:
            if not wanted:
                return
            if not transform:
                _overwrite(batch, target)
                return
            with _kept(batch) as kept:
                if not _skipped(kept, batch_id):
                    _overwrite(transform(kept), target)

    return _for_output(write, path)


def partitioned_table(path: str, partition_by: Sequence[str]) -> BatchFunction:
    """Write a micro-batch below ``path/<partition_by>/batch_id=N``: what reads one table and day visits
    that folder alone. A repeated batch overwrites exactly its own leaf folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with _whole(batch.sparkSession, path, batch_id) as wanted:
            if not wanted:
                return
            (
                batch.hint("rebalance", *partition_by)
                .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partition_by, "batch_id")
                .parquet(path)
            )

    return _for_output(write, path)


def whole_table(path: str, transform: Transform) -> BatchFunction:
    """Keep the last micro-batch, transformed, for complete output mode.

    Each is written to a folder of its own; the one before goes when it is complete, so readers of
    ``latest_table`` never meet a table that is gone or half written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _kept(batch) as kept:
            _overwrite(transform(kept), f"{path}/version={batch_id}")
        for old in _numbers(spark, path, "version"):
            if old < batch_id:
                files, place = snapshots.place(spark, f"{path}/version={old}")
                files.delete(place, True)

    return _for_output(write, path)


def latest_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table that ``whole_table`` wrote last and completely."""
    complete = [
        n
        for n in _numbers(spark, path, "version")
        if (found := snapshots.place(spark, f"{path}/version={n}/_SUCCESS"))[0].exists(found[1])
    ]
    return spark.read.schema(T.StructType.fromDDL(ddl)).parquet(f"{path}/version={complete[-1]}")


def console(rows: int = 20) -> BatchFunction:
    """Print the head of a micro-batch, for debugging."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return show


def _with_batch(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl).add("batch_id", T.LongType())


def _batch_folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Per partition folder ("" if batches lie at the top) the numbers of its batches."""
    found: dict[str, list[int]] = {}
    waiting = [""]
    while waiting:
        folder = waiting.pop()
        for name in snapshots.names(spark, f"{path}/{folder}".rstrip("/")):
            if name.startswith("batch_id="):
                found.setdefault(folder, []).append(int(name.removeprefix("batch_id=")))
            elif "=" in name:
                waiting.append(f"{folder}/{name}".lstrip("/"))
    return found


def read_batches(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A result table with its ``batch_id``: the folded batches and those behind them."""
    batches = spark.read.schema(_with_batch(ddl)).parquet(path)
    last = _finished(spark, path)
    if last is not None:
        batches = batches.filter(F.col("batch_id") <= last)
    folded = snapshots.latest(spark, path + _FOLDED)
    if not folded.folders:
        return batches
    columns = _with_batch(ddl).fieldNames()
    earlier = snapshots.read(spark, path + _FOLDED, _with_batch(ddl), folded)
    return earlier.unionByName(batches.select(*columns).filter(F.col("batch_id") > folded.upto))


def fold_batches(spark: SparkSession, path: str, ddl: str, order_by: Sequence[str] = ()) -> int:
    """Gather all batches but the last, which may still be repeated, in few files beside ``path``; gives
    the last batch folded, or -1. A stream of small batches is so kept readable: run it now and then.

    Batches that lie below partition folders are folded partition by partition. Each time only what
    is new is written; a partition whose rows lie in ``_RUNS`` versions by then is written as one. With
    ``order_by`` the rows are dealt out and sorted in that order, so that the statistics of the files
    let a reader of few keys or times skip most of them.

    What counts is named by a snapshot, which also says up to which batch it reaches; readers take
    later batches alone from their own folders. So nothing is lost or seen twice if this ends at any
    point: before the snapshot nothing has changed, after it the folders that it covers wait to be deleted.
    """
    target = path + _FOLDED
    batches = _batch_folders(spark, path)
    numbers = sorted({n for found in batches.values() for n in found})
    now = snapshots.latest(spark, target)
    upto = max(numbers[-2] if len(numbers) > 1 else -1, now.upto)
    new = {p: [n for n in found if now.upto < n <= upto] for p, found in batches.items()}
    new = {p: found for p, found in new.items() if found}
    if new:
        now = _fold(spark, path, ddl, new, now, upto, order_by)
    for partition, found in batches.items():
        for n in found:
            if n <= now.upto:
                snapshots.delete(spark, f"{path}/{partition}/batch_id={n}")
    snapshots.tidy(spark, target)
    return now.upto


def _fold(
    spark: SparkSession, path: str, ddl: str, new: dict[str, list[int]], now: snapshots.Snapshot, upto: int, order_by: Sequence[str]
) -> snapshots.Snapshot:
    target, schema = path + _FOLDED, _with_batch(ddl)
    partition_by = [part.split("=")[0] for part in next(iter(new)).split("/") if part]
    kinds = {f.name: f.dataType for f in schema.fields}
    schema = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in partition_by if c not in kinds]])
    folders = [f"{path}/{p}/batch_id={n}" for p, found in new.items() for n in found]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())
    full = [p for p in new if len(now.folders.get(p, [])) + 1 >= _RUNS]
    if full:
        rows = rows.unionByName(snapshots.read(spark, target, schema, now, full))
    order = [*partition_by, *order_by]
    if order_by:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        rows = rows.hint("rebalance", *partition_by)
    number = now.number + 1
    written = snapshots.stage(rows, target, number, partition_by)
    versions = dict(now.folders)
    for partition in written:
        versions[partition] = [number] if partition in full else [*versions.get(partition, []), number]
    found = snapshots.Snapshot(number, versions, upto)
    snapshots.publish(spark, target, found)
    return found
