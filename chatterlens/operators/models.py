"""Train, compare, save and load the classifiers."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.operators.features import COUNTS, KEPT_WORDS, WORDS, apply_stages, featurised
from chatterlens.operators.quality import classification_metrics
from chatterlens.schemas import METRIC

# Fixed value: label order assumed when a pipeline has no label index.
FALLBACK_LABELS = ["negative", "neutral", "positive"]


def classifiers() -> dict[str, Estimator]:
    """The four compared classifiers. Their parameters are fixed values."""
    return {
        "Logistic_Regression": LogisticRegression(
            maxIter=100, regParam=0.01, elasticNetParam=0.8, family="multinomial"
        ),
        "Random_Forest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=42),
        "Naive_Bayes": NaiveBayes(smoothing=1.0, modelType="multinomial"),
        "Decision_Tree": DecisionTreeClassifier(maxDepth=10, seed=42),
    }


def split_by_hash(df: DataFrame, key: str, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test) by a digest of the key: the same rows in every run and under every partitioning.

    Rows without a key are for training.
    """
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    bucket = F.coalesce(bucket, F.lit(0))
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def split_at_random(df: DataFrame, percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split into (train, test). Repeats only while the input keeps its partitioning."""
    train, test = df.randomSplit([percent / 100, 1 - percent / 100], seed=seed)
    return train, test


def train(df: DataFrame, classifier: Estimator) -> PipelineModel:
    """Fit one classifier on cleaned, labelled text."""
    with featurised(df) as (front, features):
        return PipelineModel([*front, classifier.fit(features)])


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df)


def compare_models(
    train_rows: DataFrame,
    test_rows: DataFrame,
    candidates: Mapping[str, Estimator] | None = None,
    save_to: str | None = None,
    parallelism: int = 1,
    inspect: Callable[[str, DataFrame], None] | None = None,
) -> DataFrame:
    """Fit, time, evaluate and optionally save every classifier; one METRIC row each.

    The text is featurised once and shared; ``training_time`` is that plus the classifier's own ``fit_time``. A
    classifier that fails gets a row of zeros with its error; one that only cannot be saved keeps its metrics beside
    the error. ``inspect`` is given each model's name and its predictions for the test rows, such as for a confusion
    matrix or samples. ``parallelism`` classifiers are trained at a time: iterative ones run many small jobs that
    leave most of a cluster idle, but times are only comparable at 1.
    """
    candidates = classifiers() if candidates is None else candidates
    began = time.perf_counter()
    with featurised(train_rows) as (front, features):
        # Kept for the iterations of several classifiers, and filled before the first clock starts.
        fit_on = features.persist(StorageLevel.MEMORY_AND_DISK)
        fit_on.count()
        featurising = time.perf_counter() - began
        judge_on = apply_stages(test_rows, front).drop(WORDS, KEPT_WORDS, COUNTS).persist(StorageLevel.MEMORY_AND_DISK)

        def judge(candidate: tuple[str, Estimator]) -> tuple:
            name, classifier = candidate
            try:
                started = time.perf_counter()
                fitted = classifier.fit(fit_on)
                seconds = time.perf_counter() - started
                predicted = fitted.transform(judge_on)
                scores = [float(score) for score in classification_metrics(predicted).first()]
                if inspect is not None:
                    inspect(name, predicted)
            except Exception as failure:  # one failed candidate must not end the comparison
                return (name, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, str(failure))
            error = None
            if save_to is not None:
                try:
                    save_model(PipelineModel([*front, fitted]), f"{save_to}/{name}_model")
                except Exception as failure:  # the model was judged all the same
                    error = f"not saved: {failure}"
            return (name, *scores, featurising + seconds, seconds, error)

        try:
            with ThreadPool(parallelism) as pool:
                inherit = inheritable_thread_target(train_rows.sparkSession)
                rows = pool.map(inherit(judge), candidates.items(), chunksize=1)
        finally:
            fit_on.unpersist()
            judge_on.unpersist()
    return metric_rows(train_rows.sparkSession, rows)


def metric_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Local metric records, one per model, as a DataFrame."""
    return spark.createDataFrame(rows, METRIC)


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def labels_of(model: PipelineModel) -> list[str]:
    """Labels in index order, read from the fitted label index."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            return list(stage.labels)
    return list(FALLBACK_LABELS)
