"""Sinks of a micro-batch. Each writer takes (batch, batch id) and may be called again for the same batch.

Batch ids begin at 0 with every new checkpoint. Folders are therefore named by run and batch, where a run is what one
checkpoint drives: a restart goes on with its run, a new checkpoint begins another beside it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from chatterlens.operators.keyed_table import KeyedTable
from chatterlens.sources.topics import encode_rows

BatchWriter = Callable[[DataFrame, int], None]


# Spark's local property with the id of the streaming query, which lives in its checkpoint. Fixed value.
_QUERY_ID = "sql.streaming.queryId"


def run_folder(batch: DataFrame, path: str) -> str:
    """The folder of the run that writes the batch: the time of its first write, then the checkpoint's id.

    Later runs have larger names. Batches written outside a stream belong to the run ``batch``.
    """
    context = batch.sparkSession.sparkContext
    run = context.getLocalProperty(_QUERY_ID) or "batch"
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*_{run}")
    found = pattern.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(pattern)
    if found:
        return f"{path}/{found[0].getPath().getName()}"
    return f"{path}/run={datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}_{run}"


def batch_folder(path: str, partition_by: tuple[str, ...] = ()) -> BatchWriter:
    """One Parquet folder per run and batch. A repeated batch overwrites its own folder, so replay adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if partition_by:
            # Without this every task would write a file for every value.
            batch = batch.hint("rebalance", *partition_by)
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{run_folder(batch, path)}/batch_id={batch_id}")

    return write


def keyed_documents(table: KeyedTable) -> BatchWriter:
    """Upsert batches into a keyed table, which knows the last batch of each checkpoint: a repeated batch is skipped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or "batch"
        table.upsert(batch, batch_id, run)

    return write


def topic_folder(path: str) -> BatchWriter:
    """JSON lines, one folder per run and batch: a topic that needs no service."""

    def write(batch: DataFrame, batch_id: int) -> None:
        encode_rows(batch).write.mode("overwrite").text(f"{run_folder(batch, path)}/batch_id={batch_id}")

    return write


def kafka_topic(servers: str, topic: str) -> BatchWriter:
    """JSON values to a Kafka topic. A repeated batch is sent again, as Kafka keeps no batch ids."""

    def write(batch: DataFrame, batch_id: int) -> None:
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        encode_rows(batch).write.format("kafka").options(**options).save()

    return write


def search_index_options(index: str, key: str = "id") -> dict[str, str]:
    """Connector options for a keyed search index: a later document replaces the one with the same key.

    The option names and the write operation are fixed values of the connector.
    """
    return {"es.resource": index, "es.write.operation": "index", "es.mapping.id": key}


def external_table(fmt: str, options: Mapping[str, str]) -> BatchWriter:
    """Append to any installed connector, such as a search index with ``search_index_options``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**options).mode("append").save()

    return write


def derived(writer: BatchWriter, change: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """A writer that stores a part or another shape of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(change(batch), batch_id)

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """All writers on one computed batch; an empty batch is skipped.

    A writer that fails fails the batch, which is then run again from the checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not kept.isEmpty():
                for writer in writers:
                    writer(kept, batch_id)
        finally:
            kept.unpersist()

    return write
