"""Spark session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on. Nothing here sizes the cluster: executors, memory
# and shuffle partitions come from spark-submit, and adaptive execution resizes shuffles at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Folders handed out, per application.
_scratch: dict[str, list[str]] = {}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    rocksdb_state: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, adaptive execution and, on request, the RocksDB state store.

    ``master`` stays unset on a cluster, where spark-submit names it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if rocksdb_state:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below ``spark.checkpoint.dir``, the folder all executors share.

    Where that setting is absent, a local session uses a temporary folder; a cluster has none that
    its machines share, so there it is an error. ``clear_scratch`` removes what a session left.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: several readers, one evaluation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this application, once their tables are no longer read."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
