"""Text features: label index, tokens, stop words, term counts, inverse document frequency.

The stages are those of Spark ML, so a fitted pipeline is an ordinary saved ``PipelineModel``. The second half
states the same numbers as plain aggregations over (document, term) rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    IDFModel,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.functions.text import each

# Column names and vocabulary size of the saved pipelines.
TEXT, LABEL_TEXT, LABEL = "comment_clean", "Sentiment", "label"
WORDS, KEPT_WORDS = "words", "filtered_words"
COUNTS, FEATURES = "raw_features", "features"
VOCABULARY_SIZE = 10_000

# Training rows of a partition, about. Trees hold a number for every term of the vocabulary and row, so this many take
# some 200 MB, however little text they have.
PARTITION_ROWS = 5_000


def tokenizer() -> Tokenizer:
    """Lower-case and split at every single whitespace character: doubled blanks give empty tokens."""
    return Tokenizer(inputCol=TEXT, outputCol=WORDS)


def stop_word_remover() -> StopWordsRemover:
    return StopWordsRemover(inputCol=WORDS, outputCol=KEPT_WORDS)


def token_stages(drop_empty: bool = False) -> list[Transformer]:
    """Text to kept words. Empty tokens stay in unless ``drop_empty``."""
    if not drop_empty:
        return [tokenizer(), stop_word_remover()]
    remove_empty = SQLTransformer(
        statement=f"SELECT *, array_remove(_{WORDS}, '') AS {WORDS} FROM __THIS__"
    )
    return [Tokenizer(inputCol=TEXT, outputCol=f"_{WORDS}"), remove_empty, stop_word_remover()]


def kept_words(df: DataFrame, drop_empty: bool = False) -> DataFrame:
    for stage in token_stages(drop_empty):
        df = stage.transform(df)
    return df


def fit_label_index(df: DataFrame) -> StringIndexerModel:
    """Most frequent label is 0, ties in alphabetical order, unseen labels are an error."""
    return StringIndexer(inputCol=LABEL_TEXT, outputCol=LABEL).fit(df)


def vocabulary(words: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` most frequent terms of the corpus; ties in alphabetical order."""
    terms = words.select(each(F.col(KEPT_WORDS)).alias("term")).filter("term is not null")
    terms = terms.groupBy("term").agg(F.count("*").alias("n"))
    return terms.orderBy(F.desc("n"), F.asc("term")).limit(size)


def fit_counts(words: DataFrame, size: int = VOCABULARY_SIZE) -> CountVectorizerModel:
    """Count vectors over a vocabulary whose order is the same in every run.

    The vocabulary is the model and bounded by ``size``, so it may pass through the driver.
    """
    terms = [row.term for row in vocabulary(words, size).collect()]
    return CountVectorizerModel.from_vocabulary(terms, inputCol=KEPT_WORDS, outputCol=COUNTS)


def fit_inverse_frequency(counts: DataFrame) -> IDFModel:
    return IDF(inputCol=COUNTS, outputCol=FEATURES).fit(counts)


@contextmanager
def featurised(
    train: DataFrame, size: int = VOCABULARY_SIZE, drop_empty: bool = False
) -> Iterator[tuple[list[Transformer], DataFrame]]:
    """Fit the shared front of all pipelines once; gives its stages in saved order and the training features.

    The text is read and tokenised once; label and kept words are held until the features are. The classifiers then
    see label and features only, which whoever uses them several times should persist.
    """
    tokens = token_stages(drop_empty)
    held = apply_stages(train, tokens).select(LABEL_TEXT, KEPT_WORDS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        index = fit_label_index(held)
        counter = fit_counts(held, size)
        counted = apply_stages(held, [index, counter]).select(LABEL, COUNTS)
        weights = fit_inverse_frequency(counted)
        features = weights.transform(counted).select(LABEL, FEATURES)
        partitions = math.ceil(weights.numDocs / PARTITION_ROWS)
        yield [index, *tokens, counter, weights], features.repartition(partitions) if partitions > 1 else features
    finally:
        held.unpersist()


def fit_features(train: DataFrame, size: int = VOCABULARY_SIZE, drop_empty: bool = False) -> list[Transformer]:
    """The fitted front alone."""
    with featurised(train, size, drop_empty) as (stages, _):
        return stages


def apply_stages(df: DataFrame, stages: list[Transformer]) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


# Counted once per document; words hold no white space, so it is none of them.
DOCUMENT = "\n"


def term_counts(words: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences per document (``keys``) and term. A document is one row, so its terms meet before the shuffle.

    Every document also has one row for itself, a line break, so that documents need not be read again to be counted.
    """
    marked = F.concat(F.array(F.lit(DOCUMENT)), F.col(KEPT_WORDS))
    exploded = words.select(*keys, each(marked).alias("term")).filter("term is not null")
    return exploded.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def term_weights(counts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """(term, n, df, idf) of the vocabulary: ``ln((documents + 1) / (documents with the term + 1))``."""
    terms = counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("df"))
    document = F.col("term") == DOCUMENT
    known = terms.orderBy(document.desc(), F.desc("n"), F.asc("term")).limit(size + 1)
    # At most size + 1 rows, so one window holds them all.
    documents = F.max(F.when(document, F.col("df"))).over(Window.partitionBy())
    idf = F.log((documents + 1) / (F.col("df") + 1))
    # Nulled rather than compared, as the comparison would reach the counts through a join and make them anew.
    known = known.select(F.when(~document, F.col("term")).alias("term"), "n", "df", idf.alias("idf"))
    return known.filter("term is not null")


def weighted_terms(words: DataFrame, keys: list[str], size: int = VOCABULARY_SIZE) -> DataFrame:
    """TF-IDF per document and term of the vocabulary, as rows.

    The vocabulary has at most ``size`` rows, which are broadcast; the counts are made once.
    """
    counts = term_counts(words, keys)
    weights = F.broadcast(term_weights(counts, size).select("term", "idf"))
    return counts.join(weights, "term").withColumn("tfidf", F.col("tf") * F.col("idf"))
