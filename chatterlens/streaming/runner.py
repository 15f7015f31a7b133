"""Start, await and observe streaming queries."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from chatterlens.session import hadoop_path
from chatterlens.streaming.sinks import BatchWriter

AVAILABLE_NOW = "available now"


def _writer(
    df: DataFrame, checkpoint: str | None, trigger: str | None, mode: str, name: str | None
) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer if trigger is None else writer.trigger(processingTime=trigger)


def start_batches(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    trigger: str | None = None,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write`` on every micro-batch.

    ``trigger`` is None for as fast as possible, an interval such as ``5 seconds``, or ``AVAILABLE_NOW`` to
    work off what is there and stop.
    """
    return _writer(df, checkpoint, trigger, mode, name).foreachBatch(write).start()


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table of files."""
    return _writer(df, checkpoint, trigger, "append", name).format(fmt).options(**(options or {})).start(path)


def start_console(df: DataFrame, trigger: str | None = None, rows: int = 20, name: str | None = None) -> StreamingQuery:
    """Print appended rows in full width."""
    writer = _writer(df, None, trigger, "append", name)
    return writer.format("console").option("truncate", "false").option("numRows", rows).start()


def run(queries: Iterable[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until every query has ended or one has failed, at most ``timeout`` seconds; then stop them all.

    Returns whether all of them ended by themselves. The failure of a query is raised.
    """
    queries = list(queries)
    until = None if timeout is None else time.monotonic() + timeout
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(0.2)
            if until is not None and time.monotonic() >= until:
                break
        # A query that failed after its last turn raises here.
        return all([query.awaitTermination(0.01) for query in queries])
    finally:
        for query in queries:
            query.stop()


PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("input_rows_per_second", T.DoubleType()),
        T.StructField("processed_rows_per_second", T.DoubleType()),
        T.StructField("batch_milliseconds", T.LongType()),
        T.StructField("offsets_behind", T.DoubleType()),
        T.StructField("observed", T.MapType(T.StringType(), T.LongType())),
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_bytes", T.LongType()),
        T.StructField("late_rows", T.LongType()),
    ]
)


def _offsets_behind(report: Mapping) -> float | None:
    """How far the slowest topic partition lags, where the source tells."""
    lags = [(source.get("metrics") or {}).get("maxOffsetsBehindLatest") for source in report.get("sources", [])]
    return max((float(lag) for lag in lags if lag is not None), default=None)


class ProgressLog(StreamingQueryListener):
    """Writes one JSON file for every batch that a query reports, so that none is forgotten however long it runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.running: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        context = self.spark.sparkContext
        file = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{report['runId']}-{report['batchId']}.json")
        out = file.getFileSystem(context._jsc.hadoopConfiguration()).create(file, True)
        out.write(bytearray(json.dumps(progress_row(report)).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()


@contextmanager
def progress_logged(spark: SparkSession, path: str) -> Iterator[None]:
    """Log the progress of all queries that run inside; leaves when the reports of those that have ended are written."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield
        with log.changed:
            active = {str(query.runId) for query in spark.streams.active}
            log.changed.wait_for(lambda: not log.running - active, timeout=60)
    finally:
        spark.streams.removeListener(log)


def progress_row(report: Mapping) -> dict:
    """A report as a record of ``PROGRESS``."""
    observed = {
        f"{group}.{name}": int(value)
        for group, values in (report.get("observedMetrics") or {}).items()
        for name, value in values.items()
        if value is not None
    }
    return {
        "query": report.get("name") or report["id"],
        "batch_id": report["batchId"],
        "input_rows": report["numInputRows"],
        "input_rows_per_second": float(report.get("inputRowsPerSecond") or 0.0),
        "processed_rows_per_second": float(report.get("processedRowsPerSecond") or 0.0),
        "batch_milliseconds": report.get("durationMs", {}).get("triggerExecution", 0),
        "offsets_behind": _offsets_behind(report),
        "observed": observed,
        "state_rows": _state_sum(report, "numRowsTotal"),
        "state_bytes": _state_sum(report, "memoryUsedBytes"),
        "late_rows": _state_sum(report, "numRowsDroppedByWatermark"),
    }


def _state_sum(report: Mapping, number: str) -> int:
    """A number of all stateful steps together. Rows are those that reach the step: what an aggregation has made of a
    batch's late rows, for example."""
    return sum(step.get(number) or 0 for step in report.get("stateOperators", []))


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per logged batch, with the counts observed in it."""
    return spark.read.schema(PROGRESS).json(path)


def compact_progress(spark: SparkSession, path: str) -> int:
    """Write the log's many small files as one and delete them; returns how many they were.

    Reports that are written meanwhile stay as they are. A compaction that was cut short leaves its reports twice, so
    the next one drops repeats.
    """
    files, folder = hadoop_path(spark, path)
    found = [status.getPath() for status in files.listStatus(folder) if status.getPath().getName().endswith(".json")]
    if len(found) < 2:
        return len(found)
    lines = spark.read.text([str(place) for place in found]).distinct().orderBy("value")
    out = files.create(hadoop_path(spark, f"{path}/{uuid.uuid4()}.json")[1], False)
    for row in lines.toLocalIterator():
        out.write(bytearray(f"{row.value}\n".encode()))
    out.close()
    for place in found:
        files.delete(place, False)
    return len(found)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(key, value, partition_id) of all rows that a stateful step of a query holds after its last batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def state_steps(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful steps of a query: their names, stores, partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)
