"""Queries that run the streaming jobs over whole tables and show what their sinks hold.

Each one works off its input and stops. Sinks and checkpoints lie in the shared folder of the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.times import stamp
from chatterlens.operators.latest import read_log, rows_per_batch, upsert_view
from chatterlens.operators.validate import decode_messages, route
from chatterlens.plans.fixtures import (
    ACTIVITY_SQL,
    AT_TEXT,
    MESSAGES_SQL,
    ROUTED_SQL,
    activity,
    at,
    messages,
    raw_values,
    stream_table,
    table,
    time_sql,
    time_text,
)
from chatterlens.plans.learning import SCORED_SQL, fitted, scored_by_plugin
from chatterlens.plans.registry import query
from chatterlens.schemas import DEAD_LETTER, RESULT, VALIDATED
from chatterlens.session import hadoop_path, rocksdb_state, shared_folder
from chatterlens.sources.topics import encode_messages, read_messages
from chatterlens.streaming.first_copy import first_copies
from chatterlens.streaming.jobs import (
    document_log,
    drop_repeats_stream,
    live_sentiment,
    live_sentiment_stream,
    live_table,
    score_stream,
    validate_stream,
)
from chatterlens.streaming.runner import (
    AVAILABLE_NOW,
    progress_logged,
    progress_table,
    run,
    start_batches,
    start_table,
    state_rows,
)
from chatterlens.streaming.sinks import batch_folder, fan_out, topic_folder


# A batch is held while its sinks are written, so it must not be the whole table. The jobs with a watermark
# hold nothing and read everything at once: files come in no order of time, and a cut would make rows late.
FILES_PER_BATCH = 10_000

# What the values of one file of a topic have, about; a task writes it. With more values come more files.
TOPIC_FILE_BYTES, ROW_GROUP_BYTES = 256 << 20, 8 << 20

# Every batch of copies has all ids, so they are held in groups.
FIRST_COPY_BUCKETS = 4096


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, stream_table(spark, sf_dir, "events", FILES_PER_BATCH))


@query(f"""WITH {MESSAGES_SQL} SELECT md5(text) AS text_md5, "user", "timestamp", location FROM messages""")
def stream_read_and_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of JSON values, read from its start and appended to a table."""
    folder = shared_folder(spark, "stream-append")
    encode_messages(messages(spark, sf_dir)).write.parquet(f"{folder}/topic")
    values = read_messages(spark, "parquet", f"{folder}/topic", max_per_trigger=FILES_PER_BATCH)
    decoded = decode_messages(values)
    run([start_table(decoded, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    stored = spark.read.schema(decoded.schema).parquet(f"{folder}/table")
    return stored.select(F.md5("text").alias("text_md5"), "user", "timestamp", "location")


def _run_validation(spark: SparkSession, sf_dir: str, folder: str):
    values = raw_values(_message_stream(spark, sf_dir))
    job = validate_stream(
        values, batch_folder(f"{folder}/valid"), batch_folder(f"{folder}/dead"), f"{folder}/checkpoint", AVAILABLE_NOW, at()
    )
    run([job])
    return job


@query(
    f"""WITH {ROUTED_SQL}
    SELECT coalesce(reason, 'valid') AS route, CASE WHEN reason IS NULL THEN md5(text) END AS text_md5,
      CASE WHEN reason IS NULL THEN {time_sql('parsed_time')} END AS event_time, '{AT_TEXT}' AS validation_time
    FROM routed"""
)
def stream_validated_and_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream-validate")
    _run_validation(spark, sf_dir, folder)
    valid = spark.read.schema(VALIDATED).parquet(f"{folder}/valid")
    dead = spark.read.schema(DEAD_LETTER).parquet(f"{folder}/dead")
    none = F.lit(None).cast("string")
    time = stamp(F.col("validation_time")).alias("validation_time")
    return valid.select(
        F.lit("valid").alias("route"), F.md5("text").alias("text_md5"), time_text("event_time").alias("event_time"), time
    ).unionByName(dead.select(F.col("reason").alias("route"), none.alias("text_md5"), none.alias("event_time"), time))


@query(
    f"""WITH {ROUTED_SQL}, counts AS (
      SELECT count(*) AS messages, count(*) FILTER (WHERE reason IS NULL) AS valid, count(reason) AS invalid FROM routed)
    SELECT 'progress' AS told_by, *, messages AS input_rows FROM counts UNION ALL SELECT 'sinks', *, messages FROM counts"""
)
def stream_progress_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the logged batches of the validation job report, beside what they left in its sinks."""
    folder = shared_folder(spark, "stream-progress")
    with progress_logged(spark, f"{folder}/progress"):
        _run_validation(spark, sf_dir, folder)
    observed = [F.sum(F.col("observed")[f"validation.{name}"]).alias(name) for name in ("messages", "valid", "invalid")]
    told = progress_table(spark, f"{folder}/progress").agg(*observed, F.sum("input_rows").alias("input_rows"))
    valid, dead = (rows_per_batch(read_log(spark, f"{folder}/{sink}")).agg(F.sum("n").alias("n")) for sink in ("valid", "dead"))
    held = valid.select(F.col("n").alias("valid"), dead.scalar().alias("invalid"))
    both = F.col("valid") + F.col("invalid")
    held = held.select(F.lit("sinks").alias("told_by"), both.alias("messages"), "valid", "invalid", both.alias("input_rows"))
    return told.select(F.lit("progress").alias("told_by"), "messages", "valid", "invalid", "input_rows").unionByName(held)


@query(
    f"""WITH {ROUTED_SQL}
    SELECT md5(text) AS text_md5, "user", "timestamp", {time_sql('parsed_time')} AS event_time, '{AT_TEXT}.000000' AS validation_time
    FROM routed WHERE reason IS NULL"""
)
def stream_valid_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid branch published as a topic and read back, times to the microsecond."""
    folder = shared_folder(spark, "stream-valid-topic")
    values = raw_values(_message_stream(spark, sf_dir))
    sinks = topic_folder(f"{folder}/topic"), batch_folder(f"{folder}/dead")
    run([validate_stream(values, *sinks, f"{folder}/checkpoint", AVAILABLE_NOW, at())])
    published = read_messages(spark, "text", f"{folder}/topic/*/*", stream=False)
    parsed = published.select(F.from_json(F.col("value").cast("string"), VALIDATED).alias("m")).select("m.*")
    times = [time_text(name).alias(name) for name in ("event_time", "validation_time")]
    return parsed.select(F.md5("text").alias("text_md5"), "user", "timestamp", *times)


@query(
    f"""WITH {SCORED_SQL}, stored AS (
      SELECT DISTINCT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id, md5(text) AS text_md5,
        predicted AS sentiment, '{AT_TEXT}' AS predicted_at FROM scored),
    sent AS (
      SELECT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id, md5(text) AS text_md5,
        predicted AS sentiment, '{AT_TEXT}' AS predicted_at FROM scored)
    SELECT 'documents' AS sink, * FROM stored UNION ALL SELECT 'topic', * FROM sent"""
)
def stream_scored_to_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated messages scored once and written both as keyed documents and as JSON values."""
    folder = shared_folder(spark, "stream-score")
    _run_validation(spark, sf_dir, folder)
    reader = spark.readStream.schema(VALIDATED).option("maxFilesPerTrigger", FILES_PER_BATCH)
    validated = reader.parquet(f"{folder}/valid")
    writers = [document_log(f"{folder}/documents"), topic_folder(f"{folder}/results")]
    run([score_stream(validated, fitted(spark, sf_dir), writers, f"{folder}/score", AVAILABLE_NOW, at())])
    documents = upsert_view(read_log(spark, f"{folder}/documents"))
    values = spark.read.schema("value string").text(f"{folder}/results")
    schema = "id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESULT.fields)
    sent = values.select(F.from_json("value", schema).alias("r")).select("r.*")
    columns = ["id", F.md5("text").alias("text_md5"), "sentiment", stamp(F.col("predicted_at")).alias("predicted_at")]
    return documents.select(F.lit("documents").alias("sink"), *columns).unionByName(
        sent.select(F.lit("topic").alias("sink"), *columns)
    )


@query(
    f"""WITH {SCORED_SQL}
    SELECT md5(text) AS text_md5, "user", "timestamp", location AS source, false AS model_failed,
      CASE WHEN length(text) < 5 THEN 'neutral' ELSE predicted END AS sentiment FROM scored"""
)
def stream_scored_by_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a topic scored by a plugged-in Python model and appended to a table."""
    folder = shared_folder(spark, "stream-plugin")
    valid, _ = route(decode_messages(raw_values(_message_stream(spark, sf_dir))), at())
    results = scored_by_plugin(valid, fitted(spark, sf_dir))
    run([start_table(results, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    stored = spark.read.schema(results.schema).parquet(f"{folder}/table")
    return stored.select(F.md5("text").alias("text_md5"), "user", "timestamp", "source", "model_failed", "sentiment")


def _append_events(spark: SparkSession, sf_dir: str, folder: str, parts: int) -> Iterator[int]:
    """The events in ``parts`` by number, each appended to a folder when its turn comes."""
    events = activity(spark, sf_dir)
    for part in range(parts):
        chosen = events.filter(F.pmod("event_id", F.lit(parts)) == part)
        chosen.write.mode("append").parquet(f"{folder}/in")
        yield part


def _event_stream(spark: SparkSession, sf_dir: str, folder: str, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(activity(spark, sf_dir).schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(f"{folder}/in")


@query(f"WITH {ACTIVITY_SQL} SELECT event_id, sentiment FROM activity")
def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job stopped and started again on one checkpoint while its input grows, and once without anything new."""
    folder = shared_folder(spark, "stream-restart")

    def work_off() -> None:
        rows = _event_stream(spark, sf_dir, folder).select("event_id", "sentiment")
        run([start_batches(rows, fan_out(batch_folder(f"{folder}/table")), f"{folder}/checkpoint", AVAILABLE_NOW)])

    for _ in _append_events(spark, sf_dir, folder, 3):
        work_off()
    work_off()
    return read_log(spark, f"{folder}/table").select("event_id", "sentiment")


@query(f"WITH {ACTIVITY_SQL} SELECT event_id, sentiment, copy FROM activity, (VALUES (1), (2)) c(copy)")
def stream_of_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with checkpoints of their own on one sink: both begin at batch 0, and neither loses rows."""
    folder = shared_folder(spark, "stream-two")
    for copy in (1, 2):
        rows = activity(spark, sf_dir, stream_table(spark, sf_dir, "events", FILES_PER_BATCH))
        rows = rows.select("event_id", "sentiment", F.lit(copy).alias("copy"))
        run([start_batches(rows, batch_folder(f"{folder}/table"), f"{folder}/checkpoint{copy}", AVAILABLE_NOW)])
    return read_log(spark, f"{folder}/table").select("event_id", "sentiment", "copy")


@query(f"WITH {ACTIVITY_SQL} SELECT event_id, sentiment, true AS bounded FROM activity")
def stream_in_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files read one at a time at an interval; each batch holds the rows of one file at most."""
    folder = shared_folder(spark, "stream-bounded")
    for _ in _append_events(spark, sf_dir, folder, 3):
        pass
    files = spark.read.parquet(f"{folder}/in").groupBy(F.input_file_name()).count()
    most = files.agg(F.max("count").alias("most"))
    rows = _event_stream(spark, sf_dir, folder, files=1).select("event_id", "sentiment")
    job = start_batches(rows, fan_out(batch_folder(f"{folder}/table")), f"{folder}/checkpoint", "100 milliseconds")
    job.processAllAvailable()
    run([job], timeout=0)
    log = read_log(spark, f"{folder}/table")
    bounded = rows_per_batch(log).agg(F.max("n").alias("n"), F.count("*").alias("batches"))
    held = bounded.select(((F.col("n") <= most.scalar()) & (F.col("batches") == files.agg(F.count("*")).scalar())).alias("bounded"))
    return log.select("event_id", "sentiment", held.scalar().alias("bounded"))


@query(f"""WITH {MESSAGES_SQL} SELECT md5(text) AS text_md5, true AS bounded FROM messages""")
def stream_in_batches_of_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of several files; no batch has more bytes than the largest of them."""
    folder = shared_folder(spark, "stream-bytes")
    values = encode_messages(messages(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    held = values.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    # Small row groups, so that a batch of one file is still read by many tasks.
    topic = values.repartition(max(4, math.ceil(held / TOPIC_FILE_BYTES))).write.option("parquet.block.size", ROW_GROUP_BYTES)
    topic.parquet(f"{folder}/topic")
    values.unpersist()
    files, place = hadoop_path(spark, f"{folder}/topic")
    sizes = [status.getLen() for status in files.listStatus(place) if status.getPath().getName().startswith("part-")]
    values = read_messages(spark, "parquet", f"{folder}/topic", max_bytes=max(sizes))
    run([start_batches(decode_messages(values), batch_folder(f"{folder}/table"), f"{folder}/checkpoint", AVAILABLE_NOW)])
    log = read_log(spark, f"{folder}/table")
    # Files of about the same size, so a batch of that many bytes is one of them.
    bounded = F.lit(len(sizes) == 1) | (rows_per_batch(log).agg(F.count("*")).scalar() >= min(2, len(sizes)))
    return log.select(F.md5("text").alias("text_md5"), bounded.alias("bounded"))


@query(f"WITH {ACTIVITY_SQL} SELECT event_id, sentiment, 1::BIGINT AS failures FROM activity")
def stream_sink_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second sink of a batch fails once: the query fails, and its restart writes the batch to both again."""
    folder = shared_folder(spark, "stream-retried")
    failures = []

    def fails_once(batch: DataFrame, batch_id: int) -> None:
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("sink is down")

    for _ in _append_events(spark, sf_dir, folder, 2):
        pass
    for _ in range(2):
        rows = _event_stream(spark, sf_dir, folder).select("event_id", "sentiment")
        write = fan_out(batch_folder(f"{folder}/table"), fails_once)
        try:
            run([start_batches(rows, write, f"{folder}/checkpoint", AVAILABLE_NOW)])
        except StreamingQueryException as failure:
            if "sink is down" not in str(failure):
                raise
    return read_log(spark, f"{folder}/table").select("event_id", "sentiment", F.lit(len(failures)).cast("long").alias("failures"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END AS version FROM events")
def stream_repeats_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches with other copies of the events: the first copies stay.

    Some events are first seen in the second batch; the last batch has new ids an hour late.
    """
    folder = shared_folder(spark, "stream-repeats")
    numbered = table(spark, sf_dir, "events").select("event_id")
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    first = F.when(F.col("event_id") % 7 == 3, 1).otherwise(0)
    schema = "event_id long, version int, event_time timestamp"
    for version in range(4):
        number = F.col("event_id") if version < 3 else -F.col("event_id") - 1
        seconds = F.pmod("event_id", F.lit(60)) + (120 * version if version < 3 else -3600)
        copies = numbered.filter(first <= version).select(
            number.alias("event_id"), F.lit(version).alias("version"), (begin + F.make_dt_interval(secs=seconds)).alias("event_time")
        )
        copies.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        once = drop_repeats_stream(stream, "event_id")
        run([start_table(once, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    return spark.read.schema(schema).parquet(f"{folder}/table").select("event_id", "version")


@query(
    f"""WITH {ACTIVITY_SQL}, counts AS (
      SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket, sentiment, count(*) AS n FROM activity GROUP BY ALL)
    SELECT {time_sql('bucket')} AS bucket, sentiment, n FROM counts
    WHERE bucket + INTERVAL 5 MINUTE <= (SELECT max(event_time) FROM activity) - INTERVAL 10 MINUTE"""
)
def stream_live_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that were closed when the stream ended."""
    folder = shared_folder(spark, "stream-live")
    counts = live_sentiment(activity(spark, sf_dir, stream_table(spark, sf_dir, "events")))
    run([start_table(counts, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    stored = spark.read.schema(counts.schema).parquet(f"{folder}/table")
    return stored.select(time_text("bucket").alias("bucket"), "sentiment", "n")


@query(
    f"""WITH {ACTIVITY_SQL}, counts AS (
      SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket, sentiment, count(*) AS n FROM activity GROUP BY ALL)
    SELECT {time_sql('bucket')} AS bucket, sentiment, n FROM counts
    WHERE bucket + INTERVAL 5 MINUTE <= (SELECT max(event_time) FROM activity) - INTERVAL 10 MINUTE"""
)
def stream_live_sentiment_with_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same buckets when copies of closed ones come late, in a second batch: they change nothing."""
    folder = shared_folder(spark, "stream-late")
    rows = activity(spark, sf_dir)
    newest = rows.agg(F.max("event_time")).scalar()
    closed = F.window("event_time", "5 minutes")["end"] <= newest - F.expr("interval 10 minutes")
    for part in (rows, rows.filter(closed)):
        part.write.mode("append").parquet(f"{folder}/in")
        counts = live_sentiment(_event_stream(spark, sf_dir, folder))
        run([start_table(counts, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    stored = spark.read.schema(counts.schema).parquet(f"{folder}/table")
    return stored.select(time_text("bucket").alias("bucket"), "sentiment", "n")


@query(
    """WITH copies AS (
      SELECT event_id, unnest(CASE WHEN event_id % 7 = 3 THEN [1, 2] WHEN event_id % 7 = 5 THEN [0, 1] ELSE [0, 1, 2] END) AS version
      FROM events)
    SELECT event_id, max(version) AS version FROM copies GROUP BY event_id"""
)
def stream_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches with copies of the events: the later a copy arrives, the earlier is its time, so it stays.

    Some events are missing in the first or the third batch. The last batch has new ids an hour later, which let the
    watermark pass all others, and copies that come too late.
    """
    folder = shared_folder(spark, "stream-first")
    numbered = table(spark, sf_dir, "events").select("event_id")
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    known = (F.col("event_id") % 7 != 3), F.lit(True), (F.col("event_id") % 7 != 5), F.lit(True)
    schema = "event_id long, version int, event_time timestamp"
    for version in range(4):
        seconds = F.pmod("event_id", F.lit(60)) + (120 * (2 - version) if version < 3 else 3600)
        number = F.col("event_id") if version < 3 else -F.col("event_id") - 1
        copies = numbered.filter(known[version]).select(
            number.alias("event_id"), F.lit(version).alias("version"), (begin + F.make_dt_interval(secs=seconds)).alias("event_time")
        )
        copies.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        with rocksdb_state(spark):
            first = first_copies(stream, "event_id", buckets=FIRST_COPY_BUCKETS)
            run([start_table(first, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    return spark.read.schema(schema).parquet(f"{folder}/table").select("event_id", "version")


@query(
    f"""WITH {ACTIVITY_SQL}, parts AS (
      SELECT *, event_id * 3 // (SELECT count(*) FROM events) AS part FROM activity)
    SELECT after, {time_sql('time_bucket(INTERVAL 5 MINUTE, event_time)')} AS bucket, sentiment, count(*) AS n
    FROM parts, (VALUES (0), (1), (2)) a(after) WHERE part <= after GROUP BY ALL"""
)
def stream_open_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all buckets, open ones included, as they stood after each of three batches in order of time."""
    folder, found = shared_folder(spark, "stream-open"), None
    rows = activity(spark, sf_dir)
    part = F.floor(F.col("event_id") * 3 / rows.agg(F.count("*")).scalar())
    held = live_table(spark, f"{folder}/counts")
    for after in range(3):
        rows.filter(part == after).write.mode("append").parquet(f"{folder}/in")
        run([live_sentiment_stream(_event_stream(spark, sf_dir, folder), held, f"{folder}/checkpoint", AVAILABLE_NOW)])
        now = held.read().select(F.lit(after).alias("after"), time_text("bucket").alias("bucket"), "sentiment", "n")
        found = now if found is None else found.union(now)
    return found


@query(
    f"""WITH {ACTIVITY_SQL}, counts AS (
      SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket, sentiment FROM activity GROUP BY ALL),
    ends AS (SELECT bucket + INTERVAL 5 MINUTE <= (SELECT max(event_time) FROM activity) - INTERVAL 10 MINUTE AS closed FROM counts)
    SELECT count(*) FILTER (WHERE NOT closed) AS open_buckets, count(*) FILTER (WHERE NOT closed) AS state_rows,
      count(*) FILTER (WHERE closed) AS late_rows FROM ends"""
)
def stream_state_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the state of the live counts holds at the end, read from its store and as reported, and how many counts
    of buckets and labels came too late: closed buckets are sent again in a second batch."""
    folder = shared_folder(spark, "stream-state")
    rows = activity(spark, sf_dir)
    newest = rows.agg(F.max("event_time")).scalar()
    closed = F.window("event_time", "5 minutes")["end"] <= newest - F.expr("interval 10 minutes")
    with progress_logged(spark, f"{folder}/progress"):
        for part in (rows, rows.filter(closed)):
            part.write.mode("append").parquet(f"{folder}/in")
            counts = live_sentiment(_event_stream(spark, sf_dir, folder))
            run([start_table(counts, f"{folder}/table", f"{folder}/checkpoint", AVAILABLE_NOW)])
    told = progress_table(spark, f"{folder}/progress")
    last = told.agg(F.max_by("state_rows", "batch_id").alias("state_rows"), F.sum("late_rows").alias("late_rows"))
    held = state_rows(spark, f"{folder}/checkpoint").agg(F.count("*").alias("open_buckets"))
    return held.select("open_buckets", *[last.select(name).scalar().alias(name) for name in ("state_rows", "late_rows")])
