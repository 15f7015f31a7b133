"""Messages, chat lines, comments and labels derived from whole driver tables, in Spark and in SQL.

Every event is a message: it carries the document of the same number where there is one, else a short line of
its own. By rules on the number some messages lose their text, their user, their time or their JSON form, so
that validation has work to do; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.text import drop_empty_text, with_clean_text
from chatterlens.functions.times import utc_iso
from chatterlens.schemas import MESSAGE_FIELDS

LABELS = ["negative", "neutral", "positive"]

# One processing time for all runs, so that results can be compared.
AT_TEXT = "2024-02-01 00:00:00"


def at() -> Column:
    return F.lit(AT_TEXT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files: int | None = None) -> DataFrame:
    """The same table as a stream, at most ``files`` files per batch.

    The braces make the path a pattern, as a stream source must not be one file.
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(f"{sf_dir}/{{{name}.parquet}}")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _sentiment() -> Column:
    return F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")


def activity(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Stored results without text: user, time, source and label of every event."""
    events = table(spark, sf_dir, "events") if events is None else events
    labels = table(spark, sf_dir, "labels")
    return events.join(labels, F.col("event_id") == F.col("doc_id"), "left").select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("source"),
        _sentiment().alias("sentiment"),
    )


def messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Canonical messages with their number and time."""
    events = table(spark, sf_dir, "events") if events is None else events
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("site"))
    own = F.concat_ws(" ", "event_type", "props")
    rows = events.join(documents, events.event_id == documents.doc_id, "left")
    time = F.col("ts").cast("timestamp")
    return rows.select(
        "event_id",
        F.when(_every(17), "  ").otherwise(F.coalesce("text", own)).alias("text"),
        F.when(_every(19), "").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user"),
        F.when(_every(29), "nope").otherwise(utc_iso(time)).alias("timestamp"),
        F.coalesce("site", F.lit("app")).alias("location"),
        time.alias("event_time"),
    )


def raw_values(rows: DataFrame) -> DataFrame:
    """Messages as topic values with their number; some of them broken."""
    body = F.to_json(F.struct(*MESSAGE_FIELDS), {"ignoreNullFields": "false"})
    return rows.select("event_id", F.when(_every(23), "not json").otherwise(body).cast("binary").alias("value"))


def comment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages wrapped as nested comment items; some without a channel id."""
    channel = F.when(~_every(5), F.struct(F.col("location").alias("value")))
    comment = F.struct(
        F.col("text").alias("textDisplay"),
        F.col("user").alias("authorDisplayName"),
        F.col("timestamp").alias("publishedAt"),
        channel.alias("authorChannelId"),
    )
    item = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.struct(comment.alias("snippet")).alias("topLevelComment")).alias("snippet"),
    )
    return messages(spark, sf_dir).select(F.to_json(item).alias("item"))


def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as chat lines, each third one followed by a keep-alive line."""
    turns = table(spark, sf_dir, "conversations")
    line = F.concat(
        F.lit(":"), F.col("role"), F.lit("!h@x PRIVMSG #c :"), F.regexp_replace("text", "[\\r\\n]", " ")
    )
    lines = F.when(F.col("conv_id") % 3 == 0, F.array(line, F.lit("PING :x PRIVMSG"))).otherwise(F.array(line))
    return turns.select("conv_id", "turn", F.explode(lines).alias("value"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled comments: documents that have labels, cleaned, without empty ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    rows = rows.select("doc_id", F.col("text").alias("Comment"), _sentiment().alias("Sentiment"))
    return with_clean_text(drop_empty_text(rows, "Comment"), "Comment")


# How often (of ten) each rule repeats the label; the last one always answers neutral.
RULE_MODELS = {"Steady_Rule": 8, "Loose_Rule": 6, "Neutral_Rule": 0}


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of three rules for every event, as class indexes next to the label."""
    label = F.when(F.col("sentiment") == "negative", 0).when(F.col("sentiment") == "neutral", 1).otherwise(2)
    number = F.col("event_id")

    def answer(hits: int) -> Column:
        if hits == 0:
            return F.lit(1)
        return F.when(number % 10 < hits, F.col("label")).otherwise((F.col("label") + 1 + number % 2) % 3)

    answers = [
        F.struct(F.lit(name).alias("model"), answer(hits).cast("double").alias("prediction"))
        for name, hits in RULE_MODELS.items()
    ]
    return (
        activity(spark, sf_dir)
        .withColumn("label", label)
        .select("event_id", F.col("label").cast("double").alias("label"), F.explode(F.array(*answers)).alias("a"))
        .select("event_id", "label", "a.*")
    )


_SENTIMENT_SQL = (
    "CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment"
)

ACTIVITY_SQL = f"""activity AS (
  SELECT e.event_id, 'u' || e.user_id AS "user", e.ts AS event_time, e.event_type AS source, {_SENTIMENT_SQL}
  FROM events e LEFT JOIN labels l ON l.doc_id = e.event_id)"""

MESSAGES_SQL = """messages AS (
  SELECT e.event_id,
    CASE WHEN e.event_id % 17 = 0 THEN '  ' ELSE coalesce(d.text, e.event_type || ' ' || e.props) END AS text,
    CASE WHEN e.event_id % 19 = 0 THEN '' ELSE 'u' || e.user_id END AS "user",
    CASE WHEN e.event_id % 29 = 0 THEN 'nope' ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "timestamp",
    coalesce(d.source, 'app') AS location, e.ts AS event_time
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id)"""

ROUTED_SQL = f"""{MESSAGES_SQL}, routed AS (
  SELECT *,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_time END AS parsed_time,
    CASE WHEN event_id % 23 = 0 THEN 'malformed_json'
         WHEN trim(text) = '' THEN 'missing_text'
         WHEN trim("user") = '' THEN 'missing_user' END AS reason
  FROM messages)"""

CLEAN_SQL = "regexp_replace(lower({}), '[^a-zA-Z\\s]', '', 'g')"

LABELLED_SQL = f"""labelled AS (
  SELECT * FROM (
    SELECT d.doc_id, d.text, {_SENTIMENT_SQL}, {CLEAN_SQL.format('d.text')} AS clean
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id) WHERE clean <> '')"""

PREDICTIONS_SQL = f"""{ACTIVITY_SQL}, labelled AS (
  SELECT event_id, CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS label FROM activity),
predictions AS (
  SELECT event_id, label, 'Steady_Rule' AS model,
    CASE WHEN event_id % 10 < 8 THEN label ELSE (label + 1 + event_id % 2) % 3 END AS prediction FROM labelled
  UNION ALL SELECT event_id, label, 'Loose_Rule',
    CASE WHEN event_id % 10 < 6 THEN label ELSE (label + 1 + event_id % 2) % 3 END FROM labelled
  UNION ALL SELECT event_id, label, 'Neutral_Rule', 1 FROM labelled)"""


def time_text(column: str | Column) -> Column:
    """Timestamps leave a query as text, which every engine prints alike."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def time_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
