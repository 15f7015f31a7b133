"""Quality by importance resampling: the ratio of two hashed n-gram models, sampled by Gumbel top-k.

The target model is fitted on documents labelled good, the raw model on all documents. A document's log weight is the
sum of log(target / raw) over its features, divided by the root of their number, so that chance moves short and long
texts alike. Features are words, pairs of neighbouring words (a word that follows itself is one feature whatever the
word) and runs of signs, each hashed into one of ``BUCKETS``. Adding Gumbel noise to the log
weights and taking the k largest samples k documents without replacement in proportion to their weights. The number
k is that of documents whose log weight reaches a threshold, which labelled documents that the model has not seen set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm.hashing import ALPHANUMERIC, BLANK_SEPARATED, byte_classes, mixed, slices, words_of
from chatterlens.llm.steps import kth_largest, stored

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 5.0
MAX_LABELLED = 20_000
SIGNS = byte_classes(lambda b: bool(BLANK_SEPARATED[b]) and not ALPHANUMERIC[b])
_REPEAT = np.uint64(0x2545F4914F6CDD1D)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, and the number of each one's text."""
    words, signs = words_of(texts, ALPHANUMERIC), words_of(texts, SIGNS)
    text = words.text_of_word()
    first, second = words.hashes[:-1], words.hashes[1:]
    pairs = np.where(first == second, _REPEAT, mixed(first * np.uint64(3) + second))
    inside = text[:-1] == text[1:]
    hashes = np.concatenate([words.hashes, pairs[inside], mixed(signs.hashes)])
    rows = np.concatenate([text, text[:-1][inside], signs.text_of_word()])
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), rows


def labelled_sample(labels: DataFrame, key: str, label: str, limit: int = MAX_LABELLED) -> DataFrame:
    """(label_id, good, fits): up to ``limit`` labelled ids of each class in the order of a hash, half of them to fit.

    Rows without id or label are left out; an id with several labels has the worst.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("label_id")).agg((F.min(label) > 0).alias("good"))
    known = known.withColumn("order", F.xxhash64("label_id"))
    parts = [known.where(F.col("good") == good).orderBy("order", "label_id").limit(limit) for good in (True, False)]
    return parts[0].union(parts[1]).select("label_id", "good", (F.pmod("order", F.lit(2)) == 0).alias("fits"))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (text, target) to bucket counts of all texts and of the target's, one batch for a task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in slices(batches, "text"):
        buckets, rows = features(batch.column("text"))
        target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        counts[0] += np.bincount(buckets, minlength=BUCKETS)
        counts[1] += np.bincount(buckets[target[rows]], minlength=BUCKETS)
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], names=["bucket", "n_raw", "n_target"]
    )


def fit(docs: DataFrame, sample: DataFrame, key: str, text: str) -> np.ndarray:
    """Log ratio of target and raw model for each bucket; zeros if no document is labelled good."""
    target = sample.where("good AND fits").select(F.col("label_id").alias("__label_id"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(target), F.col("id") == F.col("__label_id"), "left")
    rows = rows.select("text", F.col("__label_id").isNotNull().alias("target"))
    counted = rows.mapInArrow(_counter, "bucket long, n_raw long, n_target long").groupBy("bucket")
    raw, hit = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counted.agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target")).collect():
        raw[row.bucket], hit[row.bucket] = row.n_raw, row.n_target
    if not hit.sum():
        return np.zeros(BUCKETS)
    return np.log((hit + SMOOTHING) / (raw / raw.sum() * hit.sum() + SMOOTHING))


def with_log_weight(docs: DataFrame, ratios: np.ndarray, text: str, column: str = "log_weight") -> DataFrame:
    """Add each document's log weight; 0 for null and empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            buckets, rows = features(batch.column(text))
            total = np.bincount(rows, weights=shared.value[buckets], minlength=batch.num_rows)
            total = total / np.sqrt(np.maximum(1, np.bincount(rows, minlength=batch.num_rows)))
            yield batch.append_column(column, pa.array(total, pa.float64()))

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def threshold(scores: list[tuple[float, bool]]) -> float:
    """Middle of the gap between scores that parts good from bad with the fewest errors; of several the widest gap.

    Minus infinity, which keeps all, if one class is missing.
    """
    if len({good for _, good in scores}) < 2:
        return float("-inf")
    value = np.array(sorted(s for s, _ in scores))
    order = sorted(scores)
    good = np.array([g for _, g in order])
    lost = np.concatenate([[0], np.cumsum(good)])
    kept_bad = np.concatenate([[0], np.cumsum(~good[::-1])])[::-1]
    errors = lost + kept_bad
    gaps = np.concatenate([[0], np.diff(value), [0]])
    best = max(np.flatnonzero(errors == errors.min()), key=lambda i: gaps[i])
    if best == 0:
        return float("-inf")
    return float("inf") if best == len(value) else float(value[best - 1] + value[best]) / 2


def gumbel(*columns: Column, seed: int = 0) -> Column:
    """Gumbel noise that the values decide, so that every run and every retry draws the same."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def weighted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[DataFrame, float]:
    """(documents with log_weight and draw, least draw that is sampled).

    Documents keep their columns; ``log_weight`` and ``draw`` replace any of these names. A null or empty text has
    log weight 0. Only ``label`` is read of the labels: a document that is toxic but of good quality is good here.
    Repeated rows have equal draws and stay or go together, so ties may add to k. Without good or
    without bad labels among the documents everything is kept; an empty table gives an empty result.
    """
    docs = docs.drop("log_weight", "draw")
    sample = stored(labelled_sample(labels, key, label), "labels")
    ratios = fit(docs, sample, key, text)
    found = with_log_weight(docs, ratios, text)
    found = found.withColumn("draw", F.col("log_weight") + gumbel(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")))
    unseen = F.broadcast(sample.where("NOT fits").select(F.col("label_id").alias("__label_id"), F.col("good").alias("__good")))
    narrow = found.join(unseen, F.col(f"`{key}`") == F.col("__label_id"), "left").select("log_weight", "draw", F.col("__good").alias("good"))
    narrow = stored(narrow, "log-weights")
    held_out = [(row.log_weight, row.good) for row in narrow.where("good IS NOT NULL").select("log_weight", "good").collect()]
    least = threshold(held_out)
    k = narrow.where(F.col("log_weight") >= F.lit(least)).count()
    return found, kth_largest(narrow, "draw", k)


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The sampled documents, unchanged."""
    found, least = weighted(docs, labels, key, text, label)
    return found.where(F.col("draw") >= F.lit(least)).select(*[f"`{name}`" for name in docs.columns])
