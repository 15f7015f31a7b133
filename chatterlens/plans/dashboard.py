"""Queries behind the dashboards and the model report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.stopwords import ENGLISH
from chatterlens.functions.text import model_title, percent_text, with_clean_text
from chatterlens.operators.dashboards import (
    distribution,
    last_hour,
    newest,
    latest_rows,
    preview,
    rising_words,
    row_count,
    sentiment_columns,
    sentiment_over_time,
    top_texts,
    top_values,
    trending_words,
    volume_by,
)
from chatterlens.operators.models import read_metrics, save_metrics
from chatterlens.operators.quality import (
    best_model,
    classification_metrics,
    confusion_matrix,
    model_outcomes,
    rank_models,
)
from chatterlens.operators.validate import decode_messages, route
from chatterlens.plans.fixtures import (
    ACTIVITY_SQL,
    CLEAN_SQL,
    LABELS,
    MESSAGES_SQL,
    PREDICTIONS_SQL,
    ROUTED_SQL,
    activity,
    at,
    messages,
    raw_values,
    rule_predictions,
    table,
    time_sql,
    time_text,
)
from chatterlens.plans.registry import query
from chatterlens.session import shared_folder

_BUCKET_SQL = "time_bucket(INTERVAL 5 MINUTE, event_time)"
STOP_WORDS_SQL = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)


@query(
    f"""WITH {ROUTED_SQL}, rules AS (
      SELECT parsed_time AS event_time, CASE WHEN {CLEAN_SQL.format('text')} LIKE '%error%' THEN 'negative'
        WHEN {CLEAN_SQL.format('text')} LIKE '%purchase%' THEN 'positive' ELSE 'neutral' END AS sentiment
      FROM routed WHERE reason IS NULL AND parsed_time IS NOT NULL)
    SELECT {time_sql(_BUCKET_SQL)} AS bucket, sentiment, count(*) AS n FROM rules GROUP BY ALL"""
)
def message_sentiment_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw values, decoded, routed, cleaned, labelled by a word rule and counted per five minutes."""
    valid, _ = route(decode_messages(raw_values(messages(spark, sf_dir))), at())
    clean = F.col("comment_clean")
    rule = F.when(clean.contains("error"), "negative").when(clean.contains("purchase"), "positive").otherwise("neutral")
    counts = sentiment_over_time(with_clean_text(valid).withColumn("sentiment", rule))
    return counts.withColumn("bucket", time_text("bucket"))


@query("SELECT (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM documents) AS documents")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, documents = (row_count(table(spark, sf_dir, name)) for name in ("events", "documents"))
    return events.select(F.col("n").alias("events"), documents.scalar().alias("documents"))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT sentiment, count(*) AS n, count(*) / (SELECT count(*) FROM activity) AS share FROM activity
    GROUP BY sentiment"""
)
def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(activity(spark, sf_dir))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT {time_sql(_BUCKET_SQL)} AS bucket, sentiment, count(*) AS n FROM activity GROUP BY ALL"""
)
def sentiment_per_five_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_over_time(activity(spark, sf_dir)).withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {ACTIVITY_SQL}, dated AS (
      SELECT event_id, sentiment, CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 97 = 5 THEN TIMESTAMP '9999-12-31 23:00:00'
        ELSE event_time END AS event_time FROM activity),
    counts AS (
      SELECT {_BUCKET_SQL} AS bucket, sentiment, count(*) AS n FROM dated WHERE event_time IS NOT NULL GROUP BY ALL),
    grid AS (
      SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 5 MINUTE)) AS bucket FROM counts
      WHERE bucket < TIMESTAMP '2100-01-01'),
    cells AS (SELECT bucket, unnest(['negative', 'neutral', 'positive']) AS sentiment FROM grid)
    SELECT {time_sql('bucket')} AS bucket, sentiment, coalesce(n, 0) AS n
    FROM cells LEFT JOIN counts USING (bucket, sentiment)
    UNION ALL SELECT {time_sql('bucket')}, sentiment, n FROM counts WHERE bucket >= TIMESTAMP '2100-01-01'"""
)
def sentiment_per_five_minutes_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some messages have no time, and some one that cannot be."""
    number = F.col("event_id")
    far = F.lit("9999-12-31 23:00:00").cast("timestamp")
    time = F.when(number % 41 != 0, F.when(number % 97 == 5, far).otherwise(F.col("event_time")))
    filled = sentiment_over_time(activity(spark, sf_dir).withColumn("event_time", time), labels=LABELS, fill=True)
    return filled.withColumn("bucket", time_text("bucket"))


_ODD_LABELS_SQL = f"""{ACTIVITY_SQL}, labelled AS (
  SELECT event_time, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'mixed' ELSE sentiment END AS sentiment
  FROM activity)"""


def _odd_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    odd = F.when(number % 13 != 0, F.when(number % 31 == 0, "mixed").otherwise(F.col("sentiment")))
    return activity(spark, sf_dir).withColumn("sentiment", odd)


@query(
    f"""WITH {_ODD_LABELS_SQL}, counts AS (
      SELECT {_BUCKET_SQL} AS bucket, coalesce(sentiment, 'unlabelled') AS sentiment, count(*) AS n FROM labelled GROUP BY ALL),
    grid AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 5 MINUTE)) AS bucket FROM counts),
    cells AS (SELECT bucket, unnest(['negative', 'neutral', 'positive']) AS sentiment FROM grid
      UNION SELECT bucket, sentiment FROM counts)
    SELECT {time_sql('bucket')} AS bucket, sentiment, coalesce(n, 0) AS n FROM cells LEFT JOIN counts USING (bucket, sentiment)"""
)
def sentiment_filled_with_odd_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some messages have no label, and some one that is not among those of the dashboard."""
    filled = sentiment_over_time(_odd_labels(spark, sf_dir), labels=LABELS, fill=True)
    return filled.withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {_ODD_LABELS_SQL}
    SELECT {time_sql(_BUCKET_SQL)} AS bucket, count(*) FILTER (WHERE sentiment = 'negative') AS negative,
      count(*) FILTER (WHERE sentiment = 'neutral') AS neutral, count(*) FILTER (WHERE sentiment = 'positive') AS positive,
      count(*) FILTER (WHERE coalesce(sentiment, '') NOT IN ('negative', 'neutral', 'positive')) AS other
    FROM labelled GROUP BY ALL"""
)
def sentiment_columns_with_odd_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_columns(_odd_labels(spark, sf_dir), LABELS, other="other").withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT {time_sql(_BUCKET_SQL)} AS bucket, count(*) FILTER (WHERE sentiment = 'negative') AS negative,
      count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
      count(*) FILTER (WHERE sentiment = 'positive') AS positive FROM activity GROUP BY ALL"""
)
def sentiment_columns_per_five_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_columns(activity(spark, sf_dir), LABELS).withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT event_id, "user", source, sentiment, {time_sql('event_time')} AS event_time FROM activity
    WHERE event_time >= (SELECT max(event_time) FROM activity) - INTERVAL 1 HOUR"""
)
def messages_of_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity(spark, sf_dir)
    return last_hour(rows, newest(rows)).withColumn("event_time", time_text("event_time"))


@query(f"WITH {MESSAGES_SQL} SELECT location AS source, count(*) AS n FROM messages GROUP BY location")
def volume_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_by(messages(spark, sf_dir).withColumnRenamed("location", "source"))


@query(
    f"""WITH {ACTIVITY_SQL}
    SELECT event_id, "user", source, sentiment, {time_sql('event_time')} AS event_time FROM activity
    ORDER BY activity.event_time DESC, event_id DESC LIMIT 5"""
)
def latest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_rows(activity(spark, sf_dir), tie="event_id")
    return latest.withColumn("event_time", time_text("event_time"))


@query(
    """SELECT doc_id, left(text, 50) AS text, left(source, 50) AS source FROM documents ORDER BY doc_id LIMIT 5"""
)
def first_rows_previewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "documents"), ["text", "source"], "doc_id")


@query(
    f"""WITH {ACTIVITY_SQL} SELECT "user", count(*) AS n FROM activity GROUP BY "user" ORDER BY n DESC, "user" LIMIT 10"""
)
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(activity(spark, sf_dir), "user", 10)


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT text, count(*) AS n FROM messages GROUP BY text ORDER BY n DESC, md5(text) LIMIT 50"""
)
def top_message_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_texts(messages(spark, sf_dir))


@query(
    f"""WITH {MESSAGES_SQL}, words AS (
      SELECT unnest(regexp_split_to_array({CLEAN_SQL.format('text')}, '\\s+')) AS word FROM messages)
    SELECT word, count(*) AS n FROM words WHERE word <> '' AND word NOT IN ({STOP_WORDS_SQL})
    GROUP BY word ORDER BY n DESC, word LIMIT 50"""
)
def trending_message_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending_words(messages(spark, sf_dir))


@query(
    f"""WITH {MESSAGES_SQL}, newest AS (SELECT max(event_time) AS ends FROM messages),
    dated AS (
      SELECT regexp_split_to_array({CLEAN_SQL.format('text')}, '\\s+') AS words, event_time >= ends - INTERVAL 1 DAY AS new
      FROM messages, newest WHERE event_time BETWEEN ends - INTERVAL 8 DAY AND ends),
    words AS (SELECT unnest(words) AS word, new FROM dated),
    counts AS (
      SELECT word, count(*) FILTER (WHERE new) AS recent, count(*) FILTER (WHERE NOT new) AS earlier FROM words
      WHERE word <> '' AND word NOT IN ({STOP_WORDS_SQL}) GROUP BY word),
    totals AS (SELECT sum(recent) AS all_recent, sum(earlier) AS all_earlier FROM counts),
    rates AS (SELECT *, (recent + earlier) / (all_recent + all_earlier) AS share FROM counts, totals
      WHERE recent >= 5 AND recent * all_earlier > earlier * all_recent)
    SELECT word, recent, earlier, round(2 * (recent * ln(recent / (all_recent * share))
      + CASE WHEN earlier > 0 THEN earlier * ln(earlier / (all_earlier * share)) ELSE 0 END), 6) AS score
    FROM rates ORDER BY score DESC, word LIMIT 50"""
)
def words_risen_in_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the newest day that are more usual there than in the seven days before."""
    rows = messages(spark, sf_dir)
    return rising_words(rows, newest(rows), width="1 day", before="7 days")


# Model report


_METRICS_SQL = f"""{PREDICTIONS_SQL}, totals AS (SELECT model, count(*) AS total FROM predictions GROUP BY model),
classes AS (SELECT model, label AS class FROM predictions UNION SELECT model, prediction FROM predictions),
counted AS (
  SELECT c.model, c.class, count(*) FILTER (WHERE p.label = c.class) AS support,
    count(*) FILTER (WHERE p.prediction = c.class) AS predicted,
    count(*) FILTER (WHERE p.label = c.class AND p.prediction = c.class) AS hits
  FROM classes c JOIN predictions p ON p.model = c.model GROUP BY c.model, c.class),
rates AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS pr,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS re FROM counted),
metrics AS (
  SELECT model, sum(hits) / max(total) AS accuracy,
    sum(support * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / max(total) AS f1_score,
    sum(support * pr) / max(total) AS precision, sum(support * re) / max(total) AS recall
  FROM rates JOIN totals USING (model) GROUP BY model)"""

_SCORES = ("accuracy", "f1_score", "precision", "recall")


def _rounded(df: DataFrame) -> DataFrame:
    for score in _SCORES:
        df = df.withColumn(score, F.round(score, 6))
    return df


def _rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric records of the three rules, with a fourth that failed."""
    metrics = _rounded(classification_metrics(rule_predictions(spark, sf_dir), by=["model"]))
    columns = [F.when(F.col("model") == "Neutral_Rule", 0.0).otherwise(F.col(c)).alias(c) for c in _SCORES]
    failed = F.when(F.col("model") == "Neutral_Rule", "not trained")
    return metrics.select("model", *columns, F.lit(1.5).alias("training_time"), F.lit(0.5).alias("fit_time"), failed.alias("error"))


_RECORDS_SQL = f"""{_METRICS_SQL}, records AS (
  SELECT model, CASE WHEN model = 'Neutral_Rule' THEN 'not trained' END AS error,
    {', '.join(f"CASE WHEN model = 'Neutral_Rule' THEN 0.0 ELSE round({c}, 6) END AS {c}" for c in _SCORES)}
  FROM metrics)"""


@query(
    f"""WITH {PREDICTIONS_SQL}
    SELECT model, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
    FROM predictions GROUP BY ALL"""
)
def confusion_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(rule_predictions(spark, sf_dir), by=["model"]).orderBy("model", "label", "prediction")


@query(f"WITH {_METRICS_SQL} SELECT model, {', '.join(f'round({c}, 6) AS {c}' for c in _SCORES)} FROM metrics")
def prediction_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(classification_metrics(rule_predictions(spark, sf_dir), by=["model"]))


@query(
    f"""WITH {_RECORDS_SQL}
    SELECT replace(model, '_', ' ') AS model, printf('%.2f%%', accuracy * 100) AS accuracy,
      rank() OVER (ORDER BY accuracy DESC) AS rank FROM records WHERE error IS NULL"""
)
def models_ranked_by_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_models(_rule_metrics(spark, sf_dir))
    return ranked.select(
        model_title(F.col("model")).alias("model"), percent_text(F.col("accuracy")).alias("accuracy"), "rank"
    )


@query(
    f"""WITH {_RECORDS_SQL}
    SELECT model, f1_score, rank() OVER (ORDER BY f1_score DESC) AS rank FROM records WHERE error IS NULL"""
)
def models_ranked_by_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_models(_rule_metrics(spark, sf_dir), "f1_score").select("model", "f1_score", "rank")


@query(
    f"""WITH {_RECORDS_SQL} SELECT model, accuracy, f1_score FROM records ORDER BY accuracy DESC, model LIMIT 1"""
)
def best_model_by_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_model(_rule_metrics(spark, sf_dir)).select("model", "accuracy", "f1_score")


@query(
    f"""WITH {_RECORDS_SQL}
    SELECT count(*) FILTER (WHERE error IS NULL) AS trained, count(*) FILTER (WHERE error IS NOT NULL) AS failed
    FROM records"""
)
def trained_and_failed_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_outcomes(_rule_metrics(spark, sf_dir))


@query(f"WITH {_RECORDS_SQL} SELECT model, {', '.join(_SCORES)}, 1.5::DOUBLE AS training_time, 0.5::DOUBLE AS fit_time, error FROM records")
def metrics_saved_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "metrics")
    save_metrics(_rule_metrics(spark, sf_dir), path)
    return read_metrics(spark, path)
