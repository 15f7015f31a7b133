"""Search over stored texts: an inverted index as a table, and BM25 over the postings of the words asked for.

The index has a row for each term and block of documents: how many of the block's documents hold the term, and its
postings (document, length in words, occurrences). A frequent term has many blocks, so its postings never meet in one
task. Rows lie in folders by a hash of the term, ordered by term, so a search reads few folders and of these few row
groups. Documents are added in segments; writing a segment again replaces it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatterlens.functions.text import clean_text, each, words_of

FOLDERS = 64
BLOCK = 65_536  # documents
TASKS = 8  # for the words of a block

# The usual parameters of BM25.
SATURATION, LENGTH_SHARE = 1.2, 0.75

# Term of every document, no word: its rows count the documents and their words.
_EVERY = ""


def index_words(text: Column) -> Column:
    """Words of the cleaned text, none for a null one."""
    return F.array_remove(F.coalesce(words_of(clean_text(text)), F.array().cast("array<string>")), "")


def term_folder(term: Column, folders: int = FOLDERS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(folders))


def _last_places() -> tuple[Column, Column]:
    """The sorted ``words`` and the place of each one's last occurrence."""
    last = lambda word, place: F.when(~F.get("words", place + 1).eqNullSafe(word), place)
    return F.col("words"), F.filter(F.transform("words", last), lambda place: place.isNotNull()).alias("lasts")


def _counted() -> Column:
    """(term, tf) of a document's words, counted in its row, and of the term of every document."""
    before = lambda number: F.coalesce(F.get("lasts", number - 1), F.lit(-1))
    entry = lambda last, number: F.struct(F.get("words", last).alias("term"), (last - before(number)).alias("tf"))
    return F.concat(F.array(F.struct(F.lit(_EVERY).alias("term"), F.lit(1).alias("tf"))), F.transform("lasts", entry))


def write_segment(
    docs: DataFrame, path: str, segment: str, key: str = "id", text: str = "text", folders: int = FOLDERS, blocks: int | None = None
) -> None:
    """Index documents as one segment of the index at ``path``; a segment of that name is replaced.

    ``key`` tells documents apart, in all segments together. Documents without a word are not in the index. Without
    ``blocks`` the documents are counted for it: a block then has about ``BLOCK`` of them.
    """
    if blocks is None:
        blocks = math.ceil(docs.count() / BLOCK) or 1
    words = docs.select(F.col(key).alias("id"), F.sort_array(index_words(F.col(text))).alias("words"))
    words = words.filter(F.size("words") > 0).select("id", F.size("words").alias("length"), *_last_places())
    counts = words.select("id", "length", each(_counted()).alias("term")).select("id", "length", "term.*")
    # A term's postings of a block meet once. Tasks grow in number with the documents, so what one holds does not.
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    counts = counts.withColumn("block", block).repartition(blocks * TASKS, "term", "block")
    counts = counts.groupBy("term", "block", "id", "length").agg(F.sum("tf").cast("int").alias("tf"))
    posting = F.when(F.col("term") != _EVERY, F.struct("id", "length", "tf"))
    rows = counts.groupBy("term", "block").agg(
        F.count("*").alias("n"), F.sum("length").alias("words"), F.collect_list(posting).alias("postings")
    )
    rows = rows.withColumn("folder", term_folder(F.col("term"), folders)).hint("rebalance", "folder")
    rows.sortWithinPartitions("folder", "term").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/segment={segment}")


def query_terms(spark: SparkSession, queries: Sequence[str], folders: int = FOLDERS) -> DataFrame:
    """(query, term, folder, weight) of query strings, numbered from 0; a word said twice weighs twice."""
    asked = spark.createDataFrame(list(enumerate(queries)), "query int, text string")
    terms = asked.select("query", each(index_words(F.col("text"))).alias("term")).filter("term is not null")
    counted = terms.groupBy("query", "term").agg(F.count("*").alias("weight"))
    return counted.select("query", "term", term_folder(F.col("term"), folders).alias("folder"), "weight")


def touched_rows(spark: SparkSession, path: str, terms: Sequence[str], folders: Sequence[int]) -> DataFrame:
    """Rows of the index that a search has to read."""
    index = spark.read.parquet(path)
    return index.filter(F.col("folder").isin(*folders) & F.col("term").isin(*terms))


def search(
    spark: SparkSession,
    path: str,
    queries: Sequence[str],
    n: int = 10,
    saturation: float = SATURATION,
    length_share: float = LENGTH_SHARE,
    folders: int = FOLDERS,
) -> DataFrame:
    """(query, rank, id, score) of the ``n`` best documents for each query string by BM25.

    Queries are numbered from 0. Scores are rounded to six digits; equal ones are ranked by id. Words that no
    document has add nothing. The terms of the queries pass the driver, documents do not.
    """
    asked = query_terms(spark, queries, folders).collect()
    every = spark.range(1).select(term_folder(F.lit(_EVERY), folders)).first()[0]
    terms, places = sorted({row.term for row in asked}), sorted({row.folder for row in asked})
    counted = touched_rows(spark, path, [*terms, _EVERY], sorted({*places, every})).groupBy("term")
    known = {row.term: row for row in counted.agg(F.sum("n").alias("df"), F.sum("words").alias("words")).collect()}
    total = known.pop(_EVERY, None)
    weights = [
        (row.query, row.term, row.weight * math.log(1 + (total.df - known[row.term].df + 0.5) / (known[row.term].df + 0.5)))
        for row in asked
        if row.term in known
    ]
    weights = spark.createDataFrame(weights, "query int, term string, weight double")
    # As many rows as the query strings have words.
    found = touched_rows(spark, path, terms, places).select("term", F.explode("postings").alias("posting"))
    found = found.join(F.broadcast(weights), "term").select("query", "weight", "posting.*")
    usual = total.words / total.df if total else 1.0
    norm = saturation * (1 - length_share + length_share * F.col("length") / usual)
    scores = found.groupBy("query", "id").agg(F.round(F.sum(F.col("weight") * F.col("tf") / (F.col("tf") + norm)), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= n).select("query", "rank", "id", "score")
