"""The change watcher as a stream: each micro-batch is held against the state and moves it on."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.watch import STATE, changed, next_state
from ..sources.state import read_state

#: State of keyed streams lives in RocksDB, on disk and beside the checkpoint.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
CHANGE = "resource_id string, checksum string, event_id long, modified string"


class StateTable:
    """Snapshots of the state in a folder, one for each batch; a batch that runs again replaces its own."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def before(self, batch: int) -> DataFrame:
        return read_state(self.spark, f"{self.folder}/state-{batch - 1}", STATE)

    def write(self, batch: int, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(f"{self.folder}/state-{batch}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/state-{batch - 2}")  # a batch runs again from the one before it at most
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def watch_resources(stream: DataFrame, state: StateTable, out: str, checkpoint: str, order: str = "event_id") -> StreamingQuery:
    """Writes changed resources (resource_id, checksum, ``order``) of a stream to ``out``, a folder for each batch.

    Within a batch the newest row of a resource counts. The query takes what is there and ends.
    """
    def step(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy("resource_id").agg(F.max_by("checksum", F.struct(order, "checksum")).alias("checksum"), F.max(order).alias(order))
        known = state.before(number)
        changed(newest, known).write.mode("overwrite").parquet(f"{out}/batch-{number}")
        state.write(number, next_state(known, newest, order))

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_sightings(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """The stream without repeats of a key that come within ``late`` of each other."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


class KnownResource(StatefulProcessor):
    """Holds a resource's last checksum, and lets through what differs; all of a batch's newest rows if ``force``."""

    def __init__(self, force: bool = False) -> None:
        self.force = force

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "checksum string, event_id long, modified string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        newest = None
        for part in rows:
            for r in part.itertuples(index=False):
                own = (int(r.event_id), r.checksum, r.modified)
                newest = own if newest is None or own[:2] > newest[:2] else newest
        held = self.known.get() if self.known.exists() else None
        event, checksum, modified = newest
        if held is None or event >= held[1]:
            self.known.update((checksum, event, modified))
        elif not self.force:  # an older row than the one held
            return
        if self.force or held is None or held[0] != checksum:
            yield pd.DataFrame({"resource_id": [key[0]], "checksum": [checksum], "event_id": [event], "modified": [modified]})

    def close(self) -> None:
        pass


def watch_keyed(stream: DataFrame, out: str, checkpoint: str, force: bool = False) -> StreamingQuery:
    """Writes changed resources of a stream (resource_id, checksum, event_id, modified) to ``out`` as Parquet.

    A value state per resource is all that is kept, so a batch costs its own rows and not the whole state. Within a batch the
    newest row of a resource counts; a row older than the one held does not. The query takes what is there and
    ends; one on the same checkpoint goes on from it.
    """
    rows = stream.select("resource_id", "checksum", F.col("event_id").cast("long").alias("event_id"), "modified")
    for k, v in ROCKSDB.items():
        stream.sparkSession.conf.set(k, v)
    changes = rows.groupBy("resource_id").transformWithStateInPandas(KnownResource(force), CHANGE, "Append", "None")
    return changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
