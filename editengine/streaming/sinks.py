"""Stream sinks: layer tables, and the keyed edit store."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections import deque

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from editengine import schema as S
from editengine.operators import serving
from editengine.session import shared_dir
from editengine.sources import tables
from editengine.sources.layers import Folder

log = logging.getLogger(__name__)


def _triggered(writer: DataStreamWriter, available_now: bool, every: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def write_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    every: str = S.TRIGGER,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append to a table; the sink's commit log makes every micro-batch count exactly once.

    ``partition_by`` columns become folders, so that reads of some days or wikis open only those.
    """
    writer = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, available_now, every).start()


class StoreWriter:
    """``foreachBatch`` target: a micro-batch of silver becomes one folder of the edit store.

    The folder is named by the stream, whose id lies in its checkpoint, and the batch, and is
    overwritten. So a batch that is delivered again after a failure replaces itself, while a stream with
    a new checkpoint writes beside what is there. ``written_ms`` says which of two versions of a key came
    later. Executors write all rows; three counts per batch are observed on the way, and the last
    ``keep`` summaries are kept. Rows are sorted by wiki and time within a file, which lets a scan skip
    row groups of other wikis.
    """

    def __init__(self, path: str, keep: int = 100):
        self.path = path
        self.summaries: deque[dict] = deque(maxlen=keep)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{self.path}/stream={stream}/batch_id={batch_id}"
        order = [F.col("wiki"), F.col("wiki_lang"), F.desc("event_time"), F.desc("event_id")]
        seen = Observation("batch")
        rows = serving.serving_rows(batch).observe(seen, *serving.summary_columns("is_bot"))
        rows.sortWithinPartitions(*order).withColumn("written_ms", F.lit(time.time_ns() // 1_000_000)).write.mode("overwrite").parquet(folder)
        self.summaries.append({"batch_id": batch_id, **seen.get})
        log.info("batch: %s", self.summaries[-1])


def write_store(
    silver: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = S.TRIGGER
) -> tuple[StreamingQuery, StoreWriter]:
    target = StoreWriter(path)
    writer = silver.writeStream.foreachBatch(target).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, every).start(), target


def write_snapshot(rows: DataFrame, path: str, *version: str, as_of: Column | None = None) -> None:
    """A compacted store: newest versions, a folder per wiki and day, newest rows first in each file.

    Rows are dealt out once, by wiki and day; newest versions are chosen and files written where they lie.
    Rows expired at ``as_of`` are left out, once the newest versions are known.
    """
    laid = serving.upsert_latest(serving.by_wiki_and_day(rows), *version, also=("event_date", "salt"))
    kept = (laid if as_of is None else serving.alive(laid, as_of)).drop("salt", "stream")
    order = [F.col("wiki"), F.col("event_date"), F.col("wiki_lang"), F.desc("event_time"), F.desc("event_id")]
    files = kept.sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "static")
    files.partitionBy("wiki", "event_date").parquet(path)


def compact_store(
    spark: SparkSession, store: str, snapshot: str, as_of: Column | None = None, earlier: str | None = None
) -> None:
    """Turn a store of micro-batches, and the ``earlier`` snapshot it follows, into a snapshot at another path.

    The store may go on growing meanwhile; ``scan_store`` reads its newer batches over the snapshot.
    """
    rows, version = tables.store_versions(spark, store, earlier)
    write_snapshot(rows, snapshot, *version, as_of=as_of)


def write_messages(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").parquet(path)


def stream_kafka(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, available_now: bool = False, every: str = S.TRIGGER
) -> StreamingQuery:
    """Publish a stream of (key, value) messages. Needs the Kafka connector on the class path."""
    writer = (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, available_now, every).start()


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish (key, value) messages. Needs the Kafka connector on the class path."""
    (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is available now and read back the table it wrote."""
    spark: SparkSession = stream.sparkSession
    root = shared_dir(spark, label)
    write_parquet(stream, f"{root}/table", f"{root}/checkpoint", mode, available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


class LateRows(StreamingQueryListener):
    """Adds up, for each query, the rows that came after the watermark had passed them, from its first trigger on.

    Put it to ``spark.streams.addListener`` before the queries start; it holds one number per query.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class StreamTotals(StreamingQueryListener):
    """Observed figures of each query, added up over its batches and kept in a folder, so that they survive a restart.

    A query is known by the id in its checkpoint. Its last batch is kept apart from the batches before it: if it is
    delivered again after a failure, its figures replace themselves. ``missing`` counts batches that ended
    without a report, as when the driver is lost between the two. Put it to ``spark.streams.addListener`` before
    the queries start; it holds a few numbers per query, and a folder serves one listener at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)
        saved = sorted(x for x in self.folder.names() if x.endswith(".json"))
        self.number = int(saved[-1].removesuffix(".json")) if saved else 0
        self.state: dict[str, dict] = json.loads(self.folder.read(saved[-1])) if saved else {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = {"rows": progress.numInputRows, "busy_ms": progress.durationMs.get("triggerExecution", 0)}
        for name, row in progress.observedMetrics.items():
            figures |= {f"{name}.{k}": v for k, v in row.asDict().items()}
        own = self.state.setdefault(str(progress.id), {"batch": -1, "missing": 0, "before": {}, "last": {}})
        if progress.batchId < own["batch"]:
            return
        if progress.batchId > own["batch"]:
            own["before"] = _added(own["before"], own["last"])
            own["missing"] += progress.batchId - own["batch"] - 1
            own["batch"] = progress.batchId
        own["last"] = figures
        self._save()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def _save(self) -> None:
        """The next file is there before the one before it goes."""
        self.number += 1
        self.folder.create(f"{self.number:012d}.json", json.dumps(self.state))
        for name in self.folder.names():
            if name.endswith(".json") and int(name.removesuffix(".json")) < self.number:
                self.folder.delete(name)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Reports come behind the query; until all of an ended query's are in."""
        if not self._ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no report of the end of {query.runId}")

    def totals(self, query_id: str) -> dict[str, float]:
        """A query's figures over all its batches, with ``missing`` batches and ``rows_per_second`` while it was busy."""
        own = self.state.get(str(query_id), {"missing": 0, "before": {}, "last": {}})
        out = {"rows": 0, "busy_ms": 0, **_added(own["before"], own["last"])}
        return {**out, "missing": own["missing"], "rows_per_second": 1000 * out["rows"] / out["busy_ms"] if out["busy_ms"] else 0.0}


def _added(one: dict, other: dict) -> dict:
    return {k: one.get(k, 0) + other.get(k, 0) for k in {**one, **other}}
