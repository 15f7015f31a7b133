"""Queries over tables that are kept up to date: search index, keyed documents, maintained counts, text statistics."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.operators.heavy import read_summaries, top_between, write_summaries
from chatterlens.operators.keyed_table import KeyedTable
from chatterlens.operators.latest import with_document_id
from chatterlens.operators.search import index_words, search, write_segment
from chatterlens.operators.statistics import bayes_weights, read_statistics, text_statistics, write_statistics
from chatterlens.plans.fixtures import ACTIVITY_SQL, CLEAN_SQL, MESSAGES_SQL, activity, messages, table, time_sql, time_text
from chatterlens.plans.learning import BAYES_SQL, training
from chatterlens.plans.registry import query
from chatterlens.session import shared_folder
from chatterlens.sources.tables import look_up, write_for_look_up
from chatterlens.streaming.runner import AVAILABLE_NOW, run, start_batches
from chatterlens.streaming.sinks import keyed_documents

ASKED = 20


def asked_words(spark: SparkSession, sf_dir: str) -> list[str]:
    """Query strings: the two longest words of the first documents."""

    def longer(one: Column, two: Column) -> Column:
        by_word = F.when(one < two, -1).when(one > two, 1).otherwise(0)
        return F.when(F.length(one) == F.length(two), by_word).otherwise(F.signum(F.length(two) - F.length(one)).cast("int"))

    words = F.slice(F.array_sort(F.array_distinct(index_words(F.col("text"))), longer), 1, 2)
    asked = table(spark, sf_dir, "documents").select("doc_id", words.alias("words")).filter(F.size("words") == 2)
    return [" ".join(row.words) for row in asked.orderBy("doc_id").limit(ASKED).collect()]


_WORDS_SQL = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"


@query(
    f"""WITH {MESSAGES_SQL}, split AS (
      SELECT event_id, {_WORDS_SQL.format(CLEAN_SQL.format('text'))} AS words FROM messages),
    indexed AS (SELECT event_id, words, len(words) AS length FROM split WHERE len(words) > 0),
    totals AS (SELECT count(*) AS documents, avg(length) AS usual FROM indexed),
    asked AS (
      SELECT row_number() OVER (ORDER BY doc_id) - 1 AS query, words FROM (
        SELECT doc_id, list_distinct({_WORDS_SQL.format(CLEAN_SQL.format('text'))}) AS words FROM documents)
      WHERE len(words) >= 2 ORDER BY doc_id LIMIT {ASKED}),
    asked_words AS (SELECT query, unnest(words) AS term FROM asked),
    terms AS (
      SELECT query, term FROM asked_words
      QUALIFY row_number() OVER (PARTITION BY query ORDER BY length(term) DESC, term) <= 2),
    tf AS (
      SELECT event_id, length, term, count(*) AS tf FROM (SELECT event_id, length, unnest(words) AS term FROM indexed)
      WHERE term IN (SELECT term FROM terms) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    scores AS (
      SELECT query, event_id,
        round(sum(ln(1 + (documents - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / usual))), 6) AS score
      FROM terms JOIN tf USING (term) JOIN df USING (term), totals GROUP BY ALL)
    SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, event_id) AS rank, event_id, score FROM scores
    QUALIFY rank <= 10"""
)
def messages_found_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages indexed in two segments, and the ten best for each query string."""
    path = shared_folder(spark, "index")
    rows = messages(spark, sf_dir).select("event_id", "text")
    for part in range(2):
        write_segment(rows.filter(F.col("event_id") % 2 == part), path, f"part{part}", key="event_id")
    return search(spark, path, asked_words(spark, sf_dir)).withColumnRenamed("id", "event_id")


@query(
    f"""WITH {MESSAGES_SQL}
    SELECT DISTINCT md5("user" || chr(1) || "timestamp" || chr(1) || text) AS id, md5(text) AS text_md5 FROM messages"""
)
def upsert_in_place_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written twice into a keyed table: the second write replaces the first bucket by bucket."""
    held = KeyedTable(spark, shared_folder(spark, "keyed"))
    documents = with_document_id(messages(spark, sf_dir)).select("id", "text").persist(StorageLevel.MEMORY_AND_DISK)
    for batch_id in range(2):
        held.upsert(documents, batch_id)
    documents.unpersist()
    return held.read().select("id", F.md5("text").alias("text_md5"))


DIMENSIONS = ("bucket", "source", "sentiment")


def versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of stored results; later ones replace some labels and some sources."""
    rows = activity(spark, sf_dir).withColumn("bucket", F.window("event_time", "5 minutes")["start"])
    number, columns = F.col("event_id"), ["event_id", "user", *DIMENSIONS, "version"]
    return [
        rows.filter(number % 3 != 2).withColumn("version", F.lit(0)).select(columns),
        rows.filter(number % 2 == 0).withColumns({"sentiment": F.lit("neutral"), "version": F.lit(1)}).select(columns),
        rows.filter(number % 5 == 0).withColumns({"source": F.lit("replayed"), "version": F.lit(2)}).select(columns),
    ]


_VERSIONS_SQL = f"""{ACTIVITY_SQL}, current AS (
  SELECT event_id, "user", time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket,
    CASE WHEN event_id % 5 = 0 THEN 'replayed' ELSE source END AS source,
    CASE WHEN event_id % 5 <> 0 AND event_id % 2 = 0 THEN 'neutral' ELSE sentiment END AS sentiment,
    CASE WHEN event_id % 5 = 0 THEN 2 WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS version
  FROM activity WHERE event_id % 3 <> 2 OR event_id % 2 = 0 OR event_id % 5 = 0)"""


def _kept_versions(spark: SparkSession, sf_dir: str) -> KeyedTable:
    held = KeyedTable(spark, shared_folder(spark, "versions"), ("event_id",), dimensions=DIMENSIONS)
    for batch_id, rows in enumerate(versions(spark, sf_dir)):
        held.upsert(rows, batch_id)
    held.upsert(versions(spark, sf_dir)[1], 1)  # a replay, which comes too late to change anything
    return held


@query(
    f"""WITH {_VERSIONS_SQL}
    SELECT event_id, "user", {time_sql('bucket')} AS bucket, source, sentiment, version FROM current"""
)
def documents_upserted_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current documents after three batches and a replay."""
    return _kept_versions(spark, sf_dir).read().withColumn("bucket", time_text("bucket"))


@query(f"WITH {_VERSIONS_SQL} SELECT {time_sql('bucket')} AS bucket, source, sentiment, count(*) AS n FROM current GROUP BY ALL")
def counts_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that the batches have kept up to date, without a look at the documents."""
    return _kept_versions(spark, sf_dir).counts().withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {_VERSIONS_SQL}, totals AS (
      SELECT {time_sql('bucket')} AS bucket, source, sentiment, count(*) AS n FROM current GROUP BY ALL)
    SELECT 'counts' AS told_by, * FROM totals UNION ALL SELECT 'documents', * FROM totals"""
)
def stream_upserted_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches as a stream that is started again for each: counts as maintained and as counted anew."""
    folder = shared_folder(spark, "stream-keyed")
    held = KeyedTable(spark, f"{folder}/documents", ("event_id",), order=("version",), dimensions=DIMENSIONS)
    for rows in versions(spark, sf_dir):
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        run([start_batches(stream, keyed_documents(held), f"{folder}/checkpoint", AVAILABLE_NOW)])
    again = held.read().groupBy(*DIMENSIONS).agg(F.count("*").alias("n"))
    both = held.counts().select(F.lit("counts").alias("told_by"), *DIMENSIONS, "n")
    both = both.unionByName(again.select(F.lit("documents").alias("told_by"), *DIMENSIONS, "n"))
    return both.withColumn("bucket", time_text("bucket"))


@query(
    f"""WITH {BAYES_SQL}
    SELECT sentiment, round(prior, 6) AS prior, term, round(log_likelihood, 6) AS log_likelihood FROM bayes"""
)
def naive_bayes_from_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier's weights from statistics of four parts of the training texts, each counted by itself."""
    path = shared_folder(spark, "statistics")
    rows = training(spark, sf_dir)[0]
    for part in range(4):
        write_statistics(text_statistics(rows.filter(F.col("doc_id") % 4 == part)), path, str(part))
    found = bayes_weights(read_statistics(spark, path))
    numbers = [F.round(name, 6).alias(name) for name in ("prior", "log_likelihood")]
    return found.select(F.col("label").alias("sentiment"), "term", *numbers)


# Days after the first day of the events, and how many users to name; the last range leaves every user possible.
RANGES = ((0, 0, 3), (1, 3, 5), (0, 10_000, 10), (2, 2, 2000))


@query(
    f"""WITH {ACTIVITY_SQL}, dated AS (SELECT "user", event_time::DATE AS day FROM activity),
    ranges AS (
      SELECT part, (SELECT min(day) FROM dated) + a::INTEGER AS first, (SELECT min(day) FROM dated) + b::INTEGER AS last, most
      FROM (VALUES {", ".join(f"({part}, {a}, {b}, {n})" for part, (a, b, n) in enumerate(RANGES))}) r(part, a, b, most)),
    counts AS (SELECT part, most, "user", count(*) AS n FROM dated JOIN ranges ON day BETWEEN first AND last GROUP BY ALL)
    SELECT part, "user", n FROM counts QUALIFY row_number() OVER (PARTITION BY part ORDER BY n DESC, "user") <= most"""
)
def top_users_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most active users of several ranges of days, by summaries of the days."""
    path, rows = shared_folder(spark, "summaries"), activity(spark, sf_dir)
    write_summaries(rows, path, "user", size=200)
    begin: date = rows.agg(F.to_date(F.min("event_time"))).first()[0]
    found = None
    for part, (first, last, n) in enumerate(RANGES):
        days = begin + timedelta(days=first), begin + timedelta(days=last)
        top = top_between(read_summaries(spark, path), rows, "user", *days, n).withColumn("part", F.lit(part))
        found = top if found is None else found.union(top)
    return found


@query(
    f"""WITH {MESSAGES_SQL}, identified AS (
      SELECT event_id, md5(event_id::VARCHAR) AS id, "user", event_time FROM messages),
    asked AS (SELECT id FROM identified ORDER BY id LIMIT 10)
    SELECT event_id, id, "user", {time_sql('event_time')} AS event_time FROM identified WHERE id IN (SELECT id FROM asked)"""
)
def messages_looked_up_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages stored in order of time with Bloom filters, and those of ten ids read back."""
    path = shared_folder(spark, "look-up")
    rows = messages(spark, sf_dir).select("event_id", F.md5(F.col("event_id").cast("string")).alias("id"), "user", "text", "event_time")
    write_for_look_up(rows, path)
    asked = [row.id for row in rows.select("id").orderBy("id").limit(10).collect()]
    return look_up(spark, path, "id", *asked).select("event_id", "id", "user", time_text("event_time").alias("event_time"))
