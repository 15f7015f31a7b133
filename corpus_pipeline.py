"""From raw documents to a training mixture: five stages, each reading what the one before has written.

Quality classifier, near-duplicates, repeated passages, benchmark windows, mixture. All but the last return the
columns of ``documents``; the mixture names documents, epochs and places, without texts.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatterlens.llm import bottom_k, decontaminate, importance, mixing, paragraphs  # noqa: E402
from chatterlens.llm.steps import stored  # noqa: E402
from chatterlens.session import prepare  # noqa: E402

MAX_REPEATS = 1.25


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards those labelled good draws; the rest goes."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return importance.resample(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, similarity 0.8 or more."""
    prepare(spark)
    return bottom_k.keep_one(docs, length=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller document has too; one that is left without words goes."""
    prepare(spark)
    return paragraphs.cut_passages(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; one that loses half of its words or more goes."""
    items = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uses of documents such that sources are as even as ``MAX_REPEATS`` repeats of the scarcest allow."""
    prepare(spark)
    return mixing.mixture(docs, max_repeats=MAX_REPEATS).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
]

#: Fitted models and sampled permutations are not SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
