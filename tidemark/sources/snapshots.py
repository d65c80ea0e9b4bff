"""Snapshots of Parquet tables: every write goes to folders of its own, and one small file names those that count.

A table is kept below ``path`` as ``version=N/<partition>`` folders, none of which is ever written
again. A snapshot lists, for each partition, the versions that hold its rows. It becomes valid in one step, by
renaming a finished file to ``_snapshots/<number>``; until then readers see the snapshot before, from
then on the new one. A job that ends anywhere in between leaves folders that nobody reads, which the
next write of the same number replaces and ``tidy`` removes.

One job at a time writes a table. A second one that finishes with the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_POINTERS = "_snapshots"


class Snapshot(NamedTuple):
    """``folders``: per partition folder ("" without partitions) its versions; ``upto``: the last batch it
    holds, where batches are counted; ``buckets``: their number, where rows lie in buckets.
    """

    number: int
    folders: dict[str, list[int]]
    upto: int = -1
    buckets: int = 0


class Conflict(RuntimeError):
    """Another job has published a snapshot of this number."""


def place(spark: SparkSession, path: str):
    """File system and path object of a folder."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if it is not there."""
    files, folder = place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    files, folder = place(spark, path)
    files.delete(folder, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names(spark, f"{path}/{_POINTERS}") if n.isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Snapshot:
    files, pointer = place(spark, f"{path}/{_POINTERS}/{number}")
    stream = files.open(pointer)
    try:
        found = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    return Snapshot(number, **found)


def latest(spark: SparkSession, path: str) -> Snapshot:
    """The valid snapshot; number 0 and no folders before the first write."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else Snapshot(0, {})


def stage(df: DataFrame, path: str, number: int, partition_by: Sequence[str] = ()) -> list[str]:
    """Write rows as a version that no snapshot names yet; gives the partition folders it has."""
    target = f"{path}/version={number}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    found = [""]
    for _ in partition_by:
        found = [f"{f}/{n}".lstrip("/") for f in found for n in names(df.sparkSession, f"{target}/{f}") if "=" in n]
    return found


def publish(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Make a snapshot the valid one, in one step."""
    files, pointers = place(spark, f"{path}/{_POINTERS}")
    files.mkdirs(pointers)
    _, draft = place(spark, f"{path}/{_POINTERS}/.{uuid.uuid4().hex}")
    _, target = place(spark, f"{path}/{_POINTERS}/{snapshot.number}")
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps({k: v for k, v in snapshot._asdict().items() if k != "number"}).encode()))
    stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise Conflict(f"{path} has a snapshot {snapshot.number} already")


def read(
    spark: SparkSession, path: str, schema: T.StructType, snapshot: Snapshot | None = None, partitions: Iterable[str] | None = None
) -> DataFrame:
    """The rows of a snapshot (the valid one), or of some of its partitions, in the columns of ``schema``."""
    snapshot = snapshot or latest(spark, path)
    wanted = snapshot.folders if partitions is None else [p for p in partitions if p in snapshot.folders]
    folders = [f"{path}/version={v}/{p}".rstrip("/") for p in wanted for v in snapshot.folders[p]]
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.LongType())]))
    return found.option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def tidy(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove the folders that neither the valid snapshot nor the ``keep`` before it name; gives their number.

    Readers that began on one of these go on undisturbed. Folders of a write under way have a higher
    number than all snapshots and stay.
    """
    numbers = _numbers(spark, path)
    kept = [_load(spark, path, n) for n in numbers[-1 - keep :]]
    named = {f"version={v}/{p}".rstrip("/") for s in kept for p, versions in s.folders.items() for v in versions}
    gone = 0
    for version in names(spark, path):
        if not version.startswith("version=") or not numbers or int(version.removeprefix("version=")) > numbers[-1]:
            continue
        found = [version]
        while found and not any(f in named for f in found) and any("=" in n for n in names(spark, f"{path}/{found[0]}")):
            found = [f"{f}/{n}" for f in found for n in names(spark, f"{path}/{f}") if "=" in n]
        useless = [f for f in found if f not in named]
        for folder in [version] if len(useless) == len(found) else useless:
            delete(spark, f"{path}/{folder}")
            gone += 1
    for number in numbers[: -1 - keep]:
        delete(spark, f"{path}/{_POINTERS}/{number}")
    return gone
