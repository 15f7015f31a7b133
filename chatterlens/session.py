"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Texts are long: a batch of Spark's usual size would be held in full by the executor and its Python workers alike.
ARROW_BATCH = "2m"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = "*", memory: str = "12g", app: str = "chatterlens") -> SparkSession:
    """Single-machine session for tests and the bench; clusters bring their own."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on.

    Zone-less timestamps are read, bucketed and printed as UTC, and Python workers get batches of bounded size. On a
    cluster streaming state lies in RocksDB rather than on the heap, unless the session names another store. Workers find this package where the driver has
    it; a cluster whose machines do not share that folder gets it with ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [place for place in environment.get("PYTHONPATH", "").split(os.pathsep) if place]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    if not is_local(spark) and spark.conf.get(STATE_STORE).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, as ``transformWithState`` needs; a local session
    has another store by default."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or the warehouse if that is unset; executors reach both.

    All of a session's folders lie below one, which ``drop_shared_folders`` deletes.
    """
    return f"{_session_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _session_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/chatterlens/{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, whatever store it lies in, and the path as that system takes it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def drop_shared_folders(spark: SparkSession) -> None:
    """Delete what the session has put below ``shared_folder``; for the end of a job, when nothing reads it any more."""
    files, path = hadoop_path(spark, _session_folder(spark))
    files.delete(path, True)
