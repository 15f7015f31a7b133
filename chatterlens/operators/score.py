"""Turn messages into scored results, by a Spark ML pipeline or by a plugged-in Python model."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.feature import CountVectorizerModel, IDFModel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.functions.labels import (
    DEFAULT_LABEL,
    THREE_CLASSES,
    argmax,
    confidence,
    confidence_of,
    label_at,
    label_from_map,
)
from chatterlens.functions.text import is_short, with_clean_text
from chatterlens.functions.times import parse_time
from chatterlens.operators.features import KEPT_WORDS
from chatterlens.operators.models import labels_of
from chatterlens.schemas import RESULT
from chatterlens.sources.tables import conform

Scorer = Callable[[np.ndarray], np.ndarray]


def _as_results(scored: DataFrame, at: Column | None, keep: tuple[str, ...]) -> DataFrame:
    rows = scored.withColumn("predicted_at", F.current_timestamp() if at is None else at)
    rows = rows.withColumnRenamed("location", "source")
    if "event_time" not in rows.columns:
        rows = rows.withColumn("event_time", parse_time(F.col("timestamp")))
    schema = T.StructType([*[rows.schema[name] for name in keep], *RESULT.fields])
    return conform(rows, schema)


def score_messages(
    messages: DataFrame, model: PipelineModel, at: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Clean, classify and label messages, batch or stream; gives RESULT rows.

    ``at`` is the prediction time (default: now) and ``keep`` names extra columns to carry along.
    """
    scored = model.transform(with_clean_text(messages))
    labelled = scored.withColumn("sentiment", label_at(F.col("prediction"), labels_of(model))).withColumn(
        "confidence", confidence(F.col("probability"))
    )
    return _as_results(labelled, at, keep)


def score_udf(load: Callable[[], Scorer], classes: int, batch_size: int = 256) -> Callable[[Column], Column]:
    """Arrow-batched scoring by a plugged-in model.

    ``load`` runs once per Python worker and returns a function from an array of texts to an array of class
    scores, one row per text. Null texts never reach the model. When a batch fails its texts are tried one by
    one, and those that fail again get null scores.
    """

    def make() -> Scorer:
        import numpy

        model = load()

        def one_by_one(texts):
            rows = numpy.full((len(texts), classes), numpy.nan)
            for i in range(len(texts)):
                try:
                    rows[i] = model(texts[i : i + 1])[0]
                except Exception:
                    pass
            return rows

        def scores(texts):
            rows = numpy.full((len(texts), classes), numpy.nan)
            given = numpy.array([text is not None for text in texts], dtype=bool)
            if given.any():
                chosen = texts[given]
                try:
                    rows[given] = model(chosen)
                except Exception:
                    rows[given] = one_by_one(chosen)
            return rows

        return scores

    return predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)


def score_with_udf(
    messages: DataFrame,
    scorer: Callable[[Column], Column],
    model_input: Column | None = None,
    labels: Mapping[int, str] = THREE_CLASSES,
) -> DataFrame:
    """Add ``sentiment``, ``confidence`` and ``model_failed`` by a plugged-in model; batch or stream.

    Null and short texts are neutral without asking the model; texts on which the model fails are neutral too,
    but flagged, so that failures can be counted.
    """
    text = F.col("text")
    guarded = is_short(text)
    given = F.when(~guarded, text if model_input is None else model_input)
    scored = messages.withColumn("_guarded", guarded).withColumn("_scores", scorer(given))
    index = argmax(F.col("_scores"))
    return (
        scored.withColumn("sentiment", label_from_map(index, labels, DEFAULT_LABEL))
        .withColumn("confidence", confidence_of(F.col("_scores")))
        .withColumn("model_failed", ~F.col("_guarded") & index.isNull())
        .drop("_guarded", "_scores")
    )


def udf_results(scored: DataFrame, at: Column | None = None) -> DataFrame:
    """RESULT rows of messages scored by a plugged-in model, with the failure flag."""
    return _as_results(scored, at, ("model_failed",))


def joined_words(column: str = KEPT_WORDS) -> Column:
    """Kept words as one text for a plugged-in model; words hold no blanks, so the join can be undone."""
    return F.when(F.size(column) > 0, F.array_join(column, " ")).otherwise("\n")


def naive_bayes_scorer(model: PipelineModel) -> Callable[[], Scorer]:
    """Loader of a numpy scorer with the weights of a fitted naive Bayes pipeline.

    Its input is ``joined_words``. It holds one row of weights per vocabulary term, and the vocabulary is
    bounded, so the broadcast is too.
    """
    stages = {type(stage): stage for stage in model.stages}
    bayes = stages[NaiveBayesModel]
    weights = (bayes.theta.toArray() * stages[IDFModel].idf.toArray()).T
    shared = SparkSession.active().sparkContext.broadcast(
        (stages[CountVectorizerModel].vocabulary, weights, bayes.pi.toArray())
    )

    def load() -> Scorer:
        import numpy

        terms, term_weights, priors = shared.value
        place = {term: i for i, term in enumerate(terms)}

        def scores(texts):
            words = [[] if text == "\n" else text.split(" ") for text in texts]
            row = numpy.repeat(numpy.arange(len(words)), [len(found) for found in words])
            at = numpy.fromiter((place.get(word, -1) for found in words for word in found), int, len(row))
            rows = numpy.tile(priors, (len(words), 1))
            numpy.add.at(rows, row[at >= 0], term_weights[at[at >= 0]])
            return rows

        return scores

    return load
