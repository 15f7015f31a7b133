"""Column functions between class indexes, class scores and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: output order of the three-class text model.
THREE_CLASSES = {0: "negative", 1: "neutral", 2: "positive"}

DEFAULT_LABEL = "neutral"


def label_at(index: Column, labels: Sequence[str]) -> Column:
    """Label at a class index, null when the index is null or out of range."""
    return F.get(F.array(*[F.lit(label) for label in labels]), index.cast("int"))


def label_from_map(
    index: Column, labels: Mapping[int, str] = THREE_CLASSES, default: str = DEFAULT_LABEL
) -> Column:
    """Label of a class index by lookup, ``default`` for anything unknown."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[index.cast("int")], F.lit(default))


def argmax(scores: Column) -> Column:
    """Index of the first largest score, null for an empty or null array."""
    position = F.array_position(scores, F.array_max(scores)) - 1
    return F.when(position >= 0, position.cast("int"))


def confidence_of(scores: Column) -> Column:
    """Probability of the largest of several unnormalised log scores."""
    best = F.array_max(scores)
    shares = F.transform(scores, lambda score: F.exp(score - best))
    return 1 / F.aggregate(shares, F.lit(0.0), lambda total, share: total + share)


def confidence(probability: Column) -> Column:
    """Probability of the predicted class."""
    return F.array_max(vector_to_array(probability))
