"""Message topics: where raw values come from and how messages become values again.

A topic is anything that yields a ``value`` column. On a cluster that is Kafka; a folder of JSON lines or of
Parquet files with a ``value`` column behaves the same and needs no service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.schemas import MESSAGE_FIELDS

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

#: Where a value stood in its topic: later records of a key have larger ones.
ARRIVAL = "struct<time timestamp, partition int, offset long>"


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Kafka reader options. ``max_per_trigger`` limits one batch, ``min_partitions`` splits large offset ranges."""
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting must be earliest or latest, not {starting!r}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_messages(
    spark: SparkSession,
    fmt: str,
    location: str,
    servers: str | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    stream: bool = True,
    max_bytes: int | None = None,
) -> DataFrame:
    """Raw values of a topic as a binary ``value`` column, and for Kafka and Parquet their ``arrival``.

    ``fmt`` is ``kafka`` (``location`` is the topic), ``text`` (a folder of JSON lines) or ``parquet`` (a folder
    of files with a ``value`` and, if it has been kept, an ``arrival`` column). A folder is always read from its start.
    A batch of a folder is limited by files or by ``max_bytes``, and has one file at least; Kafka counts messages only.
    """
    if max_bytes is not None and (fmt == "kafka" or max_per_trigger is not None):
        raise ValueError("bytes limit the batches of a folder, instead of a number of files")
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        if servers is None:
            raise ValueError("kafka needs servers")
        if not stream and starting != "earliest":
            raise ValueError("a batch has to start at the earliest offset")
        options = topic_options(servers, location, starting, max_per_trigger, min_partitions)
        return reader.format("kafka").options(**options).load().select(
            "value", F.struct(F.col("timestamp").alias("time"), "partition", "offset").alias("arrival")
        )
    if fmt not in ("text", "parquet"):
        raise ValueError(f"unknown topic format {fmt!r}")
    if starting != "earliest":
        raise ValueError("a folder can only be read from its start")
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if fmt == "text":
        return reader.schema("value string").text(location).select(F.col("value").cast("binary").alias("value"))
    return reader.schema(f"value binary, arrival {ARRIVAL}").parquet(location)


def encode_messages(df: DataFrame) -> DataFrame:
    """One JSON value per message; absent fields are written as null."""
    body = F.to_json(F.struct(*MESSAGE_FIELDS), {"ignoreNullFields": "false"})
    return df.select(body.cast("binary").alias("value"))


def encode_rows(df: DataFrame) -> DataFrame:
    """One JSON value per row with all of its columns, times to the microsecond; null fields are left out."""
    return df.select(F.to_json(F.struct("*"), {"timestampFormat": TIME_FORMAT}).alias("value"))
