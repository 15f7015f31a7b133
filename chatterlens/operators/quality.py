"""Quality of predictions and ranking of models, in DataFrame algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (label, prediction), optionally for several models side by side."""
    return df.groupBy(*by, label, prediction).agg(F.count("*").alias("n"))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, weighted F1, weighted precision and weighted recall, one row per ``by`` group.

    One pass counts the confusion cells; the rest works on those few rows. Each cell tells its label that it
    was expected n times and its prediction that it was predicted n times.
    """
    cells = confusion_matrix(df, label, prediction, by)
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    expected = F.struct(
        F.col(label).alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")
    )
    predicted = F.struct(
        F.col(prediction).alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")
    )
    classes = (
        cells.select(*by, F.explode(F.array(expected, predicted)).alias("side"))
        .select(*by, "side.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(2 * precision * recall, precision + recall)
    total = F.sum("support")
    return classes.groupBy(*by).agg(
        _ratio(F.sum("hits"), total).alias("accuracy"),
        _ratio(F.sum(F.col("support") * f1), total).alias("f1_score"),
        _ratio(F.sum(F.col("support") * precision), total).alias("precision"),
        _ratio(F.sum(F.col("support") * recall), total).alias("recall"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def rank_models(metrics: DataFrame, by: str = "accuracy") -> DataFrame:
    """Models that were trained, best first, with their rank. One row per model, so one window holds them all."""
    trained = metrics.filter(F.col("error").isNull())
    ranked = trained.withColumn("rank", F.rank().over(Window.orderBy(F.desc(by))).cast("long"))
    return ranked.orderBy("rank", "model")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest accuracy; a failed model counts as 0, ties go to the first name."""
    return metrics.orderBy(F.desc(F.coalesce("accuracy", F.lit(0.0))), F.asc("model")).limit(1)


def model_outcomes(metrics: DataFrame) -> DataFrame:
    """How many models were trained and how many failed."""
    return metrics.agg(
        F.count_if(F.col("error").isNull()).alias("trained"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
