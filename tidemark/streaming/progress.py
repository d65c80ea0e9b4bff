"""What each micro-batch did, recorded from its own progress report: no message is read for it.

Counts that are wanted beside Spark's own are observed while the batch runs (``observed``). Reports
come in behind the batches, from Spark's listener, and are stored one small file a batch, which a report
that comes twice overwrites.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark import schemas
from tidemark.sources import snapshots

PROGRESS = (
    "query_id string, query_name string, batch_id bigint, input_rows bigint, watermark timestamp, "
    "state_rows bigint, late_rows bigint, observed map<string,bigint>"
)

_OBSERVED = "tidemark_counts"


def observed(df: DataFrame, **counts: Column) -> DataFrame:
    """``df`` with counts that are taken as its rows pass; without any, the number of its rows."""
    wanted = counts or {"rows": F.count(F.lit(1))}
    return df.observe(_OBSERVED, *[c.cast("bigint").alias(n) for n, c in wanted.items()])


class _Recorder(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.failures: list[Exception] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self._store(json.loads(event.progress.json))
        except Exception as failure:  # noqa: BLE001 - a listener must not stop the bus; raised when recording ends
            self.failures.append(failure)

    def _store(self, found: dict) -> None:
        state = found.get("stateOperators", [])
        row = {
            "query_id": found["id"],
            "query_name": found.get("name"),
            "batch_id": found["batchId"],
            "input_rows": found["numInputRows"],
            "watermark": found.get("eventTime", {}).get("watermark"),
            "state_rows": sum(s["numRowsTotal"] for s in state),
            "late_rows": sum(s["numRowsDroppedByWatermark"] for s in state),
            "observed": found.get("observedMetrics", {}).get(_OBSERVED, {}),
        }
        folder = f"{self.path}/query={found['id']}"
        files, target = snapshots.place(self.spark, f"{folder}/{found['batchId']}.json")
        stream = files.create(target, True)
        stream.write(bytearray((json.dumps(row) + "\n").encode()))
        stream.close()


@contextmanager
def recording(spark: SparkSession, path: str) -> Iterator[None]:
    """Store the progress of all queries of the session meanwhile; reports under way are waited for."""
    recorder = _Recorder(spark, path)
    spark.streams.addListener(recorder)
    try:
        yield
        spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(recorder)
    if recorder.failures:
        raise recorder.failures[0]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The recorded batches. A batch that read nothing is there too: it may have dropped state."""
    if not snapshots.names(spark, path):
        return spark.createDataFrame([], schemas.struct(PROGRESS))
    return spark.read.schema(schemas.struct(PROGRESS)).json(f"{path}/query=*")
