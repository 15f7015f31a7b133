"""Token counts by two-tier look-up: a broadcast table of frequent pieces, then each worker's cache.

A piece is a run of text from one blank or line break to the next. Where a blank or line break follows a character
that is no white space, byte-level BPE begins a new pre-token whatever stands around, so a text has as many tokens as
its pieces have together. Frequent pieces of a bounded sample of the documents are encoded once; all others are encoded
by the worker that meets them and kept in its cache. Pieces are never shuffled, and all texts but the sample are read
once. The sample decides speed only: every count comes from the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from chatterlens.llm.hashing import slices

FREQUENT = 1 << 15
SAMPLE = 20_000  # documents that the frequent pieces are taken from
SAMPLE_TASKS = 8
CACHED = 1 << 19
SHORT = 64

#: White space next to white space, at an end, or of another kind than blank and line break.
_UNEVEN = re.compile(r"[ \n]{2}|^[ \n]|[ \n]$|[^\S \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


@cache
def tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer as its file sets it up, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@cache
def special_strings(path: str) -> re.Pattern | None:
    strings = [token.content for token in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, strings))) if strings else None


def encoded_lengths(path: str, texts: list[str]) -> list[int]:
    return [len(found) for found in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def pieces(text: str) -> list[str]:
    """The text cut into pieces; joined they are the text."""
    if _UNEVEN.search(text):
        return _CUT.split(text)
    first, *rest = text.replace("\n", " \n").split(" ")
    return [first, *[piece if piece[0] == "\n" else " " + piece for piece in rest]]


class Lengths:
    """Token counts of pieces: the frequent ones of the table, and what the worker has met since it was last full."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.path, self.frequent, self.known = path, frequent, dict(frequent)

    def of(self, texts: list[str]) -> list[int]:
        special = special_strings(self.path)
        cut = [[text] if special and special.search(text) else pieces(text) for text in texts]
        fresh = list(set().union(*cut).difference(self.known))
        self.known.update(zip(fresh, encoded_lengths(self.path, fresh)))
        counts = [sum(map(self.known.__getitem__, parts)) for parts in cut]
        if len(self.known) > CACHED:
            self.known = dict(self.frequent)
        else:
            for piece in fresh:
                if len(piece) > SHORT:
                    del self.known[piece]
        return counts


# One cache for each worker process, shared by the tasks that it runs with the same table.
_worker: dict[tuple[str, int], Lengths] = {}


def _counter(path: str, table, column: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = table.value
        if (path, len(frequent)) not in _worker:
            _worker.clear()
            _worker[path, len(frequent)] = Lengths(path, frequent)
        lengths = _worker[path, len(frequent)]
        for batch in slices(batches, column):
            counts = lengths.of(["" if text is None else text for text in batch.column(column).to_pylist()])
            kept = [name for name in batch.schema.names if name != column]
            columns = [batch.column(name) for name in kept] + [pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_tokens"])

    return run


def _summary(path: str) -> Callable:
    """Arrow function: text to the task's most frequent short pieces with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(pieces(text) if text else ())
            if len(counts) > CACHED:
                counts = Counter(dict(counts.most_common(FREQUENT)))
        found = [(piece, n) for piece, n in counts.most_common(FREQUENT) if n > 1 and len(piece) <= SHORT]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["piece", "n"]
        )

    return run


def frequent_pieces(docs: DataFrame, text: str, path: str) -> dict[str, int]:
    """Token counts of up to ``FREQUENT`` pieces that are frequent in about ``SAMPLE`` documents, chosen by their hash.

    Equal texts count once.
    The sample is read by ``SAMPLE_TASKS`` tasks, each of which sends its ``FREQUENT`` most frequent pieces of at most
    ``SHORT`` characters to the driver, whatever the number of documents. The table decides speed only, never a count.
    """
    parts = max(1, docs.count() // SAMPLE)
    texts = docs.select(F.col(text).alias("text"))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == 0).distinct().repartition(SAMPLE_TASKS)
    found: Counter[str] = Counter()
    for row in sample.mapInArrow(_summary(path), "piece string, n long").collect():
        found[row.piece] += row.n
    special = special_strings(path)
    known = sorted(found, key=lambda piece: (-found[piece], piece))[:FREQUENT]
    known = [piece for piece in known if not (special and special.search(piece))]
    return dict(zip(known, encoded_lengths(path, known)))


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Replace the text column by ``n_tokens``: tokens of the whole text as the tokenizer file at ``path`` gives them.

    No begin, end or added special tokens, truncation or padding; a text that has a special token's string is encoded
    whole, so that the library treats the string as it does by default. For byte-level BPE. Null and empty texts have
    0 tokens. Rows keep all other columns (one named ``n_tokens`` is replaced); repeated rows are counted each.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, text, path))
    rows = docs.drop("n_tokens") if text != "n_tokens" else docs
    fields = [field for field in rows.schema.fields if field.name != text]
    return rows.mapInArrow(_counter(path, table, text), T.StructType([*fields, T.StructField("n_tokens", T.LongType())]))
