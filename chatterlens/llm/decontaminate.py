"""Benchmark decontamination: a broadcast set of hashed benchmark windows, scanned over every document."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm.hashing import ALPHANUMERIC, Words, slices, words_of

WINDOW = 10
BLOCK_BYTES = 32 << 20
_FILTER_BITS = 20

Windows = dict[int, dict[int, list[tuple[bytes, set]]]]  # length -> hash -> (words, ids of items)


class WindowSet:
    """Windows of some benchmark items: a bit filter per length before exact look-up of the words."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.by_length: Windows = {}
        ids = [i for i, _ in items]
        words = words_of(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC)
        for item, (first, end) in enumerate(zip(words.first, words.first[1:])):
            length = min(window, end - first)
            for at in range(first, end - length + 1) if length else ():
                key = spelled(words, at, length)
                entries = self.by_length.setdefault(int(length), {}).setdefault(key, set())
                entries.add(ids[item])
        self.filters = {}
        for length, windows in self.by_length.items():
            spelled_out = words_of(pa.array([key.decode() for key in windows]), ALPHANUMERIC)
            hashes, valid = spelled_out.windows(length)
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[hashes[valid] >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters[length] = bits, np.unique(hashes[valid])

    def hits(self, words: Words) -> Iterator[tuple[int, int, set]]:
        """First word, length and item ids of every window of the set in the texts."""
        for length, (bits, known) in self.filters.items():
            if len(words.hashes) < length:
                continue
            hashes, valid = words.windows(length)
            maybe = np.flatnonzero(bits[hashes >> np.uint64(64 - _FILTER_BITS)] & valid)
            maybe = maybe[np.isin(hashes[maybe], known)]
            for at in maybe:
                found = self.by_length[length].get(spelled(words, at, length))
                if found:
                    yield int(at), length, found


def spelled(words: Words, at: int, length: int) -> bytes:
    """Normalised words of a window, blank-separated."""
    span = words.data[words.starts[at] : words.ends[at + length - 1]]
    return b" ".join(ALPHANUMERIC[span].tobytes().replace(b"\0", b" ").split())


def blocks_of(benchmark: DataFrame, item: str, text: str, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items in as many hash blocks as keep each block's text near ``block_bytes``; one for usual benchmarks."""
    items = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    if blocks == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) for block in range(blocks)]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add n_words, hit_spans (word positions, end exclusive, sorted, apart) and hit_items to every document.

    Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased. A window is
    ``window`` consecutive words of an item; a shorter item with words is one window. A document word inside any
    occurrence of a window is hit. Hash matches are confirmed on the words themselves.

    Each block of items is broadcast; its text is bounded by ``block_bytes`` (checked, one item may exceed it). A
    larger benchmark takes one pass over the documents for each block, without a shuffle of documents.

    Null or empty texts have no words and no hits. Repeated rows are kept, each judged alone. Items without an id hit
    words but are not listed; repeated ids are listed once. Other columns are passed through; a document column of
    one of the added names is replaced.
    """
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("hit_items", T.ArrayType(T.LongType())),
    ]
    docs = docs.drop("n_words", "hit_spans", "hit_items")
    for block in blocks_of(benchmark, item, item_text, block_bytes):
        rows = [(row.item, row.text) for row in block.collect()]
        windows = docs.sparkSession.sparkContext.broadcast(WindowSet(rows, window))
        docs = docs.mapInArrow(_scanner(windows, text), _with(docs.schema, added))
    return docs


def _with(schema: T.StructType, added: list[T.StructField]) -> T.StructType:
    names = {f.name for f in added}
    return T.StructType([f for f in schema.fields if f.name not in names] + added)


def _scanner(windows, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = words_of(batch.column(text), ALPHANUMERIC)
            counts = np.diff(words.first)
            spans, items = _earlier(batch, "hit_spans"), _earlier(batch, "hit_items")
            for at, length, ids in windows.value.hits(words):
                row = int(np.searchsorted(words.first, at, "right")) - 1
                begin = at - int(words.first[row])
                spans.setdefault(row, []).append([begin, begin + length])
                items.setdefault(row, []).extend(ids)
            added = {
                "n_words": pa.array(counts, pa.int64()),
                "hit_spans": pa.array([merged(spans.get(i, [])) for i in range(len(counts))], pa.list_(pa.list_(pa.int64()))),
                "hit_items": pa.array(
                    [sorted(set(items[i]) - {None}) if i in items else [] for i in range(len(counts))], pa.list_(pa.int64())
                ),
            }
            kept = [name for name in batch.schema.names if name not in added]
            columns = {name: batch.column(name) for name in kept} | added
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _earlier(batch: pa.RecordBatch, column: str) -> dict[int, list]:
    """What an earlier block has found."""
    if column not in batch.schema.names:
        return {}
    return {i: found for i, found in enumerate(batch.column(column).to_pylist()) if found}


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def n_hit(spans: str = "hit_spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", drop_share: float = 0.5, window: int = WINDOW
) -> DataFrame:
    """Documents with the hit words cut out of their text; one that loses ``drop_share`` of its words or more is dropped.

    A cut leaves a line break. What a cut joins is scanned again, until no item of the block is hit. All columns keep
    names and order; rows without hits are unchanged, null and empty texts included. Repeated rows stay repeated.
    """
    names = docs.columns
    counters = [T.StructField("__words", T.LongType()), T.StructField("__cut", T.LongType())]
    for block in blocks_of(benchmark, "item_id", "text"):
        rows = [(row.item, row.text) for row in block.collect()]
        windows = docs.sparkSession.sparkContext.broadcast(WindowSet(rows, window))
        docs = docs.mapInArrow(_cutter(windows, text), _with(docs.schema, counters))
    return docs.where(~((F.col("__cut") > 0) & (F.col("__cut") >= drop_share * F.col("__words")))).select(*names)


def _cutter(windows, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text)
            words = words_of(texts, ALPHANUMERIC)
            rows = {int(np.searchsorted(words.first, at, "right")) - 1 for at, _, _ in windows.value.hits(words)}
            earlier = "__cut" in batch.schema.names
            n_words = batch.column("__words") if earlier else pa.array(np.diff(words.first), pa.int64())
            n_cut = batch.column("__cut").to_numpy().copy() if earlier else np.zeros(len(texts), np.int64)
            if rows:
                values = texts.to_pylist()
                for row in rows:
                    values[row], lost = without_hits(windows.value, values[row])
                    n_cut[row] += lost
                texts = pa.array(values, texts.type)
            changed = {text: texts, "__words": n_words, "__cut": pa.array(n_cut, pa.int64())}
            columns = {name: batch.column(name) for name in batch.schema.names} | changed
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def without_hits(windows: WindowSet, value: str) -> tuple[str, int]:
    """The text without the words that are hit, and how many these were."""
    lost = 0
    while True:
        words = words_of(pa.array([value]), ALPHANUMERIC)
        spans = merged([[at, at + length] for at, length, _ in windows.hits(words)])
        if not spans:
            return value, lost
        raw, out, at = words.data.tobytes(), [], 0
        for begin, end in spans:
            out.append(raw[at : words.starts[begin]])
            at = words.ends[end - 1]
            lost += end - begin
        value = b"\n".join([*out, raw[at:]]).decode()
