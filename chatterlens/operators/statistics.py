"""Additive statistics of labelled texts: what naive Bayes over TF-IDF needs, kept in parts that merge by sums.

A part has, for each label and term, the occurrences and the documents that hold the term, and for each label the
number of its documents. Inverse document frequency is the same for all rows of a term, so it is left out of the sums
and multiplied in at the end: new texts are counted alone and the old ones are not read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.functions.text import each
from chatterlens.operators.features import DOCUMENT, KEPT_WORDS, LABEL_TEXT, VOCABULARY_SIZE, kept_words
from chatterlens.session import hadoop_path

# Fixed value: additive smoothing of the classifier.
SMOOTHING = 1.0


def text_statistics(rows: DataFrame, drop_empty: bool = False) -> DataFrame:
    """(label, term, tf, df) of labelled cleaned texts; the line break is the term that every document has once.

    A row is a document. Terms are counted within their row, so no document id is shuffled.
    """
    words = kept_words(rows, drop_empty).select(F.col(LABEL_TEXT).alias("label"), F.col(KEPT_WORDS).alias("words"))
    # Equal words of a row stand side by side once sorted, so the first of each is known by the one before it.
    ordered = words.withColumn("words", F.array_sort(F.concat(F.array(F.lit(DOCUMENT)), "words")))
    first = F.transform("words", lambda word, at: F.struct(word.alias("term"), (at == 0) | (F.get("words", at - 1) != word)))
    each_word = ordered.select("label", each(first).alias("word")).select("label", "word.term", F.col("word.col2").alias("first"))
    counted = each_word.groupBy("label", "term").agg(F.count("*").alias("tf"), F.count_if("first").alias("df"))
    return counted.filter("term is not null")


def merged(*parts: DataFrame) -> DataFrame:
    """Statistics of all parts together."""
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy("label", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def write_statistics(statistics: DataFrame, path: str, part: str) -> None:
    """Store a part; one of that name is replaced, so writing it again adds nothing."""
    statistics.write.mode("overwrite").parquet(f"{path}/part={part}")


def drop_statistics(spark: SparkSession, path: str, part: str) -> bool:
    """Forget the documents of a part; returns whether there was one."""
    files, folder = hadoop_path(spark, f"{path}/part={part}")
    return files.delete(folder, True)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of all stored parts together."""
    return merged(spark.read.parquet(path).drop("part"))


def term_idf(statistics: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """(term, n, df, idf) of the ``size`` most frequent terms; ties in alphabetical order."""
    terms = statistics.filter(F.col("term") != DOCUMENT).groupBy("term").agg(F.sum("tf").alias("n"), F.sum("df").alias("df"))
    documents = statistics.filter(F.col("term") == DOCUMENT).agg(F.sum("df")).scalar()
    known = terms.orderBy(F.desc("n"), F.asc("term")).limit(size)
    return known.withColumn("idf", F.log((documents + 1) / (F.col("df") + 1)))


def bayes_weights(statistics: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """(label, prior, term, log_likelihood) of multinomial naive Bayes over TF-IDF, as the classifier fits it.

    The vocabulary has at most ``size`` rows and there is one row per label, so both are broadcast.
    """
    known = term_idf(statistics, size)
    documents = statistics.filter(F.col("term") == DOCUMENT).select("label", F.col("df").alias("documents"))
    total = documents.agg((F.sum("documents") + SMOOTHING * F.count("*")).alias("total"))
    prior = F.log(F.col("documents") + SMOOTHING) - F.log(total.scalar())
    labels = documents.select("label", prior.alias("prior"))
    counted = statistics.join(F.broadcast(known.select("term", "idf")), "term")
    weights = counted.select("label", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    totals = weights.groupBy("label").agg(F.sum("weight").alias("total"))
    totals = labels.join(F.broadcast(totals), "label", "left").fillna(0.0, ["total"])
    terms = known.agg(F.count("*")).scalar()
    # Every label has every term: the labels are few, so each term carries the list of them.
    held = totals.agg(F.collect_list(F.struct("label", "prior", "total")).alias("labels")).scalar()
    cells = known.select("term", F.inline(held)).join(weights, ["label", "term"], "left")
    likelihood = F.log(F.coalesce("weight", F.lit(0.0)) + SMOOTHING) - F.log(F.col("total") + SMOOTHING * terms)
    return cells.select("label", "prior", "term", likelihood.alias("log_likelihood"))
