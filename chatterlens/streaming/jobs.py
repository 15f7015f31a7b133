"""The streaming jobs: validate and route, score and fan out, remove repeats, count live."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterlens.operators.keyed_table import KeyedTable
from chatterlens.operators.latest import with_document_id
from chatterlens.operators.score import score_messages
from chatterlens.operators.validate import dead_letters, decode_messages, valid_messages, with_reason
from chatterlens.streaming.runner import start_batches
from chatterlens.streaming.sinks import BatchWriter, batch_folder, derived, fan_out, keyed_documents


def validate_stream(
    values: DataFrame,
    valid: BatchWriter,
    dead: BatchWriter,
    checkpoint: str,
    trigger: str | None = None,
    at: Column | None = None,
    name: str = "validate",
) -> StreamingQuery:
    """Decode a topic once and send each message to the valid or to the dead-letter sink.

    The counts of both branches are reported with every batch. They are there to watch the job: a part that is
    computed again after the loss of an executor is counted again. The sinks hold the exact numbers.
    """
    time = F.current_timestamp() if at is None else at
    judged = with_reason(decode_messages(values)).withColumn("_at", time)
    # Only dead letters need the raw value; valid ones would hold their text twice while both sinks are written.
    judged = judged.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
    counted = judged.observe(
        "validation",
        F.count("*").alias("messages"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count("reason").alias("invalid"),
    )
    write = fan_out(
        derived(valid, lambda batch: valid_messages(batch, F.col("_at"))),
        derived(dead, lambda batch: dead_letters(batch, F.col("_at"))),
    )
    return start_batches(counted, write, checkpoint, trigger, name=name)


def score_stream(
    messages: DataFrame,
    model: PipelineModel,
    writers: list[BatchWriter],
    checkpoint: str,
    trigger: str | None = None,
    at: Column | None = None,
    name: str = "score",
) -> StreamingQuery:
    """Score a stream of messages once and write every batch to all sinks.

    The prediction time is set before the batch is handed out, so that all sinks hold the same value.
    """
    results = with_document_id(score_messages(messages, model, at, _kept(messages)))
    return start_batches(results, fan_out(*writers), checkpoint, trigger, name=name)


def score_topic_stream(
    values: DataFrame,
    model: PipelineModel,
    writers: list[BatchWriter],
    dead: BatchWriter,
    checkpoint: str,
    trigger: str | None = None,
    at: Column | None = None,
    name: str = "score",
) -> StreamingQuery:
    """Decode a topic once, score its valid messages once and write them to all sinks, and the others to ``dead``."""
    judged = with_reason(decode_messages(values)).withColumn("_at", F.current_timestamp() if at is None else at)

    def results(batch: DataFrame) -> DataFrame:
        kept = _kept(batch)
        valid = valid_messages(batch, F.col("_at"), (*kept, "_at"))
        return with_document_id(score_messages(valid, model, F.col("_at"), kept))

    write = fan_out(derived(fan_out(*writers), results), derived(dead, lambda batch: dead_letters(batch, F.col("_at"))))
    return start_batches(judged, write, checkpoint, trigger, name=name)


def _kept(messages: DataFrame) -> tuple[str, ...]:
    """Where a message stood in its topic, if the topic tells; it decides between two writes of one key."""
    return ("arrival",) if "arrival" in messages.columns else ()


def document_log(path: str) -> BatchWriter:
    """Sink of ``upsert_view``: results by batch, pruned by event date."""
    dated = lambda batch: batch.withColumn("event_date", F.to_date("event_time"))
    return derived(batch_folder(path, ("event_date",)), dated)


def drop_repeats_stream(df: DataFrame, key: str = "id", time: str = "event_time", delay: str = "10 minutes") -> DataFrame:
    """Pass each event id once, as ``drop_repeats`` does for a batch: its first copy. Repeats are recognised for ``delay``.

    First is the copy of the earlier micro-batch, within the rows that a task reads at a time the one of the earlier
    time. A copy that is late is not passed, but one that is not late stands in for it.

    Streaming state has no map-side half, so an id that makes up much of the stream would send all of its copies to
    one task. Of each Arrow batch therefore only the first and the last copy of an id go on.
    """

    def ends(batches):
        import numpy
        import pyarrow

        for batch in batches:
            rows = pyarrow.array(numpy.arange(batch.num_rows))
            copies = pyarrow.table([batch.column(key), batch.column(time), rows], names=["key", "time", "row"])
            ordered = copies.sort_by([("time", "ascending"), ("row", "ascending")])
            ordered = ordered.append_column("place", rows).group_by("key", use_threads=False)
            found = ordered.aggregate([("place", "first"), ("place", "last"), ("row", "first"), ("row", "last")])
            places = pyarrow.concat_arrays([found[f"place_{end}"].combine_chunks() for end in ("first", "last")])
            kept = pyarrow.concat_arrays([found[f"row_{end}"].combine_chunks() for end in ("first", "last")])
            _, once = numpy.unique(places.to_numpy(), return_index=True)
            yield batch.take(kept.take(pyarrow.array(once)))

    thinned = df.mapInArrow(ends, df.schema)
    return thinned.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def unique_values(values: DataFrame, delay: str) -> DataFrame:
    """Raw values of a topic without those that the topic has had within ``delay`` of their arrival here.

    A missing value repeats none: all of them pass.
    """
    value_id = F.coalesce(F.md5("value"), F.uuid())
    keyed = values.withColumn("value_id", value_id).withColumn("seen_at", F.current_timestamp())
    return drop_repeats_stream(keyed, "value_id", "seen_at", delay).drop("value_id", "seen_at")


def live_sentiment(
    results: DataFrame, width: str = "5 minutes", delay: str = "10 minutes", time: str = "event_time"
) -> DataFrame:
    """Messages per time bucket and label, each bucket given once, when no message can fall into it any more."""
    counted = (
        results.filter(F.col(time).isNotNull())
        .withWatermark(time, delay)
        .groupBy(F.window(time, width), "sentiment")
        .agg(F.count("*").alias("n"))
    )
    return counted.select(F.col("window.start").alias("bucket"), F.col("window.end").alias("closed"), "sentiment", "n")


def live_table(spark: SparkSession, path: str) -> KeyedTable:
    """The table that ``live_sentiment_stream`` keeps: one row per bucket and label."""
    return KeyedTable(spark, path, ("bucket", "sentiment"), buckets=8, order=())


def live_sentiment_stream(
    results: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    trigger: str | None = "5 seconds",
    width: str = "5 minutes",
    delay: str = "10 minutes",
    time: str = "event_time",
    name: str = "live",
) -> StreamingQuery:
    """Keep the counts of all buckets, open ones included: every batch replaces the counts that it has changed.

    State holds a bucket as ``live_sentiment`` does; the table keeps it for good.
    """
    counts = live_sentiment(results, width, delay, time)
    return start_batches(counts, keyed_documents(table), checkpoint, trigger, mode="update", name=name)
