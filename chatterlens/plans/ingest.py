"""Queries over sources, decoding, validation, scalar functions and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.functions import text as text_functions
from chatterlens.functions.labels import argmax, label_at, label_from_map
from chatterlens.functions.text import drop_empty_text, is_short, with_clean_text
from chatterlens.functions.times import parse_time, stamp, utc_iso
from chatterlens.operators.dashboards import newest, since
from chatterlens.operators.latest import (
    compact_log,
    drop_repeats,
    latest_per_key,
    read_log,
    upsert_view,
    with_document_id,
)
from chatterlens.operators.validate import (
    decode_messages,
    extract_fields,
    route,
    validation_report,
    with_reason,
)
from chatterlens.plans.fixtures import (
    ACTIVITY_SQL,
    AT_TEXT,
    CLEAN_SQL,
    LABELLED_SQL,
    LABELS,
    MESSAGES_SQL,
    ROUTED_SQL,
    activity,
    at,
    chat_lines,
    comment_items,
    labelled,
    messages,
    raw_values,
    table,
    time_sql,
    time_text,
)
from chatterlens.plans.registry import query
from chatterlens.schemas import RESULT
from chatterlens.session import shared_folder
from chatterlens.sources.chat import chat_lines_to_messages, chat_messages_only
from chatterlens.sources.comments import comments_to_messages
from chatterlens.sources.tables import CSV_OPTIONS, conform, read_labelled_csv, read_results, write_results
from chatterlens.sources.topics import encode_messages, encode_rows, read_messages

_MESSAGE_COLUMNS = """md5(text) AS text_md5, "user", "timestamp", location"""


def _digested(df: DataFrame, *others: str) -> DataFrame:
    return df.select(*others, F.md5("text").alias("text_md5"), "user", "timestamp", "location")


# Sources


@query(
    f"""WITH {LABELLED_SQL}
    SELECT md5(text) AS comment_md5, sentiment, count(*) AS n FROM labelled GROUP BY ALL"""
)
def labelled_comments_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "labelled-csv")
    labelled(spark, sf_dir).select("Comment", "Sentiment").write.options(**CSV_OPTIONS).csv(path)
    rows = read_labelled_csv(spark, path)
    return rows.groupBy(F.md5("Comment").alias("comment_md5"), F.col("Sentiment").alias("sentiment")).agg(
        F.count("*").alias("n")
    )


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT CAST(event_id AS VARCHAR) AS id, md5(text) AS text_md5, "user", "timestamp",
      CASE WHEN event_id % 5 = 0 THEN 'Unknown' ELSE location END AS location
    FROM messages"""
)
def nested_comments_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(comments_to_messages(comment_items(spark, sf_dir)), "id")


@query(
    f"""WITH turns AS (
      SELECT role, trim(regexp_replace(text, '[\\r\\n]', ' ', 'g')) AS text FROM conversations)
    SELECT md5(text) AS text_md5, left(role, 50) AS "user", '2024-02-01T00:00:00.000000Z' AS "timestamp",
      'Twitch' AS location FROM turns WHERE length(text) >= 1"""
)
def chat_lines_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(chat_lines_to_messages(chat_lines(spark, sf_dir), at=at()))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def chat_lines_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat_messages_only(chat_lines(spark, sf_dir))
    return lines.groupBy(F.regexp_extract("value", "^:([^!]*)!", 1).alias("role")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT keyword, event_id, {time_sql('ts')} AS published_at FROM (
      SELECT event_type AS keyword, event_id, ts,
        row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r <= 5"""
)
def newest_videos_per_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("keyword"), "event_id", "ts")
    newest = latest_per_key(events, ["keyword"], "ts", "event_id", 5)
    return newest.select("keyword", "event_id", time_text("ts").alias("published_at"))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT "user", event_id, sentiment FROM (
      SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY event_time DESC, event_id DESC) AS r FROM activity)
    WHERE r <= 50"""
)
def newest_messages_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(activity(spark, sf_dir), ["user"], "event_time", "event_id", 50)
    return newest.select("user", "event_id", "sentiment")


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT source, sentiment, count(*) AS n FROM activity
    WHERE event_time >= (SELECT max(event_time) FROM activity) - INTERVAL 1 DAY GROUP BY ALL"""
)
def stored_results_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "results")
    write_results(conform(activity(spark, sf_dir), RESULT), path)
    stored = read_results(spark, path)
    recent = since(stored, newest(stored), "1 day")
    return recent.groupBy("source", "sentiment").agg(F.count("*").alias("n"))


@query(
    """SELECT event_id, CAST(user_id AS VARCHAR) AS "user", try_cast(event_type AS DOUBLE) AS confidence,
      CAST(NULL AS VARCHAR) AS sentiment FROM events"""
)
def results_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("user"), F.col("event_type").alias("confidence"), "props"
    )
    declared = [f for f in RESULT.fields if f.name in ("user", "confidence", "sentiment")]
    return conform(rows, T.StructType([T.StructField("event_id", T.LongType()), *declared]))


# Decoding, projections and filters


@query(
    f"""WITH {MESSAGES_SQL}, sent AS (
      SELECT event_id, event_id % 23 = 0 AS malformed,
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE md5(text) END AS text_md5,
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE "user" END AS "user",
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE location END AS location FROM messages)
    SELECT * FROM sent"""
)
def decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(decode_messages(raw_values(messages(spark, sf_dir))), "event_id", "malformed")


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT event_id, {', '.join(f'CASE WHEN event_id % 23 = 0 THEN NULL ELSE {c} END AS {a}' for c, a in [
        ('md5(text)', 'text_md5'), ('"user"', '"user"'), ('"timestamp"', '"timestamp"'), ('location', 'location')
    ])} FROM messages"""
)
def extracted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(extract_fields(raw_values(messages(spark, sf_dir))), "event_id")


@query(f"WITH {MESSAGES_SQL} SELECT {_MESSAGE_COLUMNS} FROM messages")
def encoded_and_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "topic")
    encode_messages(messages(spark, sf_dir)).write.parquet(path)
    return _digested(decode_messages(read_messages(spark, "parquet", path, stream=False)))


@query(
    f"SELECT doc_id, md5({CLEAN_SQL.format('text')}) AS clean_md5, length({CLEAN_SQL.format('text')}) AS size "
    "FROM documents"
)
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_clean_text(table(spark, sf_dir, "documents"))
    size = F.length("comment_clean").cast("long")
    return documents.select("doc_id", F.md5("comment_clean").alias("clean_md5"), size.alias("size"))


@query(
    f"""WITH {MESSAGES_SQL} SELECT location, count(*) AS n FROM messages
    WHERE {CLEAN_SQL.format('text')} <> '' GROUP BY location"""
)
def messages_with_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_empty_text(messages(spark, sf_dir))
    return rows.groupBy("location").agg(F.count("*").alias("n"))


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT event_id, "user", location AS source, 'stream' AS channel FROM messages"""
)
def renamed_with_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(
        "event_id", "user", F.col("location").alias("source"), F.lit("stream").alias("channel")
    )


# Validation


@query(
    f"""WITH {ROUTED_SQL}
    SELECT {_MESSAGE_COLUMNS}, {time_sql('parsed_time')} AS event_time, true AS validated,
      '{AT_TEXT}' AS validation_time FROM routed WHERE reason IS NULL"""
)
def valid_messages_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = route(decode_messages(raw_values(messages(spark, sf_dir))), at())
    return valid.select(
        F.md5("text").alias("text_md5"),
        "user",
        "timestamp",
        "location",
        time_text("event_time").alias("event_time"),
        "validated",
        stamp(F.col("validation_time")).alias("validation_time"),
    )


@query(
    f"""WITH {ROUTED_SQL}
    SELECT coalesce(reason, 'valid') AS route, count(*) AS n FROM routed GROUP BY ALL"""
)
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_reason(decode_messages(raw_values(messages(spark, sf_dir))))
    return judged.groupBy(F.coalesce("reason", F.lit("valid")).alias("route")).agg(F.count("*").alias("n"))


@query(
    f"""WITH {ROUTED_SQL}
    SELECT reason, CASE WHEN reason = 'malformed_json' THEN md5('not json') END AS raw_md5,
      '{AT_TEXT}' AS validation_time, count(*) AS n FROM routed WHERE reason IS NOT NULL GROUP BY ALL"""
)
def dead_letter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "dead-letters")
    _, dead = route(decode_messages(raw_values(messages(spark, sf_dir))), at())
    dead.write.parquet(path)
    broken = F.when(F.col("reason") == "malformed_json", F.md5("raw"))
    time = stamp(F.col("validation_time"))
    return (
        spark.read.schema(dead.schema)
        .parquet(path)
        .groupBy("reason", broken.alias("raw_md5"), time.alias("validation_time"))
        .agg(F.count("*").alias("n"))
    )


@query(
    f"""WITH {MESSAGES_SQL}, problems AS (
      SELECT 'malformed_json' AS reason FROM messages WHERE event_id % 23 = 0
      UNION ALL SELECT 'missing_text' FROM messages WHERE event_id % 23 <> 0 AND event_id % 17 = 0
      UNION ALL SELECT 'missing_user' FROM messages WHERE event_id % 23 <> 0 AND event_id % 19 = 0
      UNION ALL SELECT 'bad_timestamp' FROM messages WHERE event_id % 23 <> 0 AND event_id % 29 = 0)
    SELECT reason, count(*) AS n FROM problems GROUP BY reason"""
)
def validation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_report(decode_messages(raw_values(messages(spark, sf_dir))))


@query(
    f"""WITH {MESSAGES_SQL} SELECT event_id, md5(text) AS text_md5 FROM messages"""
)
def repeats_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    copies = F.when(F.col("event_id") % 5 == 0, 2).otherwise(1)
    repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return drop_repeats(repeated, "event_id", "copy").select("event_id", F.md5("text").alias("text_md5"))


# Scalar functions


@query(
    f"""WITH {MESSAGES_SQL} SELECT event_id,
      CASE WHEN event_id % 29 = 0 THEN NULL ELSE {time_sql('event_time')} END AS event_time FROM messages"""
)
def timestamps_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select("event_id", time_text(parse_time(F.col("timestamp"))).alias("event_time"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso
    FROM events"""
)
def timestamps_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", stamp(time).alias("stamp"), utc_iso(time).alias("iso"))


@query(
    """SELECT event_id,
      CASE event_id % 5 WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' WHEN 3 THEN 'positive' END AS by_position,
      CASE event_id % 5 WHEN 1 THEN 'negative' WHEN 3 THEN 'positive' ELSE 'neutral' END AS by_map FROM events"""
)
def labels_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = (F.col("event_id") % 5 - 1).cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id", label_at(index, LABELS).alias("by_position"), label_from_map(index).alias("by_map")
    )


@query(
    """SELECT doc_id, md5(CASE WHEN instr(text, '.') > 0 THEN left(text, instr(text, '.') - 1) ELSE text END) AS before_md5,
      md5(trim(CASE WHEN instr(text, '.') > 0 THEN substr(text, instr(text, '.') + 1) END, chr(10) || ' ')) AS after_md5,
      md5(replace(text, ':', '')) AS removed_md5, left(text, 50) AS head FROM documents"""
)
def text_split_and_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text_functions.before_first(text, ".")).alias("before_md5"),
        F.md5(text_functions.strip(text_functions.after_first(text, "."))).alias("after_md5"),
        F.md5(text_functions.remove_mark(text, ":")).alias("removed_md5"),
        text_functions.truncate(text, 50).alias("head"),
    )


@query(
    """WITH short AS (
      SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN lang WHEN doc_id % 11 <> 0 THEN text END AS text
      FROM documents)
    SELECT doc_id, CASE WHEN text IS NULL OR length(text) < 5 THEN 'neutral' ELSE 'model' END AS answer FROM short"""
)
def short_texts_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id")
    text = F.when(number % 13 == 0, F.col("lang")).when(number % 11 != 0, F.col("text"))
    documents = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return documents.select("doc_id", F.when(is_short(F.col("text")), "neutral").otherwise("model").alias("answer"))


@query(
    """SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS best,
      round(CAST(list_max(embedding) AS DOUBLE), 6) AS score FROM embeddings"""
)
def best_scoring_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", argmax(scores).alias("best"), F.round(F.array_max(scores).cast("double"), 6).alias("score")
    )


# Sinks


@query(
    f"""WITH {MESSAGES_SQL} SELECT hour, event_id, md5(text) AS text_md5 FROM (
      SELECT strftime(event_time, '%Y-%m-%d %H') AS hour, event_id, text,
        row_number() OVER (PARTITION BY date_trunc('hour', event_time) ORDER BY event_id DESC) AS r FROM messages)
    WHERE r = 1"""
)
def upsert_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = messages(spark, sf_dir).select(
        F.date_format("event_time", "yyyy-MM-dd HH").alias("hour"), F.col("event_id").alias("batch_id"), "text"
    )
    current = upsert_view(log, ["hour"])
    return current.select("hour", F.col("batch_id").alias("event_id"), F.md5("text").alias("text_md5"))


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT DISTINCT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id, md5(text) AS text_md5 FROM messages"""
)
def upsert_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, compact = shared_folder(spark, "log"), shared_folder(spark, "compact")
    documents = with_document_id(messages(spark, sf_dir)).select("id", "text")
    for run in ("1", "2"):  # the second write replaces the first, document by document
        documents.write.parquet(f"{log}/run={run}/batch_id=0")
    compact_log(spark, log, compact)
    current = upsert_view(read_log(spark, compact))
    return current.select("id", F.md5("text").alias("text_md5"))


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT md5(text) AS text_md5, "user", "timestamp",
      {time_sql("event_time")} AS event_time, location AS source
    FROM messages"""
)
def results_published_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "results-topic")
    rows = conform(messages(spark, sf_dir).withColumnRenamed("location", "source"), RESULT)
    encode_rows(rows).write.text(path)
    values = spark.read.schema("value string").text(path)
    parsed = values.select(F.from_json("value", RESULT).alias("r")).select("r.*")
    return parsed.select(
        F.md5("text").alias("text_md5"), "user", "timestamp", time_text("event_time").alias("event_time"), "source"
    )


@query(
    f"""WITH {MESSAGES_SQL} SELECT "user", event_id, md5(text) AS text_md5 FROM messages
    QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY event_time DESC, event_id DESC) = 1"""
)
def upsert_in_arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All writes of a key in one batch: the one that came last into the topic stays."""
    log = shared_folder(spark, "arrival-log")
    place = F.struct(F.col("event_time").alias("time"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    rows = messages(spark, sf_dir).select("user", "event_id", "text", place.alias("arrival"))
    rows.write.parquet(f"{log}/run=1/batch_id=0")
    current = upsert_view(read_log(spark, log), ["user"])
    return current.select("user", "event_id", F.md5("text").alias("text_md5"))
