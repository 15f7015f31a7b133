"""The whole way of a message, as one chain of DataFrame functions for batch and stream alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from chatterlens.operators.latest import with_document_id
from chatterlens.operators.score import score_messages
from chatterlens.operators.validate import decode_messages, route


def results_of(values: DataFrame, model: PipelineModel, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw values to (scored results with document id, dead letters)."""
    valid, dead = route(decode_messages(values), at)
    return with_document_id(score_messages(valid, model, at)), dead
