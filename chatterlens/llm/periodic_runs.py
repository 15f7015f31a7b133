"""Periodic runs of words by block convolution: exact number-theoretic transforms at dyadic scales, then extension.

The scale ``L`` finds the periods from ``L`` to ``2 * L`` (the least one all from 1). Words are cut into blocks; a run
of at least three periods contains a whole block of its scale together with the block's next occurrence, one period
further on. For every block a convolution with the window behind it gives the sum of squared differences of the word
codes at each distance, as an exact integer: all sums are below the modulus of the transform. A sum of zero is an
occurrence, its distance the seed of a run, which is confirmed and extended on the words themselves.

A transform is a product with the matrix of powers of a root of unity (two of them with twiddle factors between, for
long blocks). With a modulus of 20 bits the products are exact in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterlens.llm.hashing import mixed, slices

LEAST = 24  # words of a run
TIMES = 3  # periods of a run

MODULUS = 786_433  # prime, 3 * 2 ** 18 + 1
GENERATOR = 10  # of all numbers prime to the modulus
SMALLEST = 8  # words of a block of the least scale: 2 * 8 - 1 words hold a whole block of a run less its period
LONGEST = 2048  # words of a block; larger scales slide it over several windows
DENSE = 128  # size up to which one matrix makes the transform
CELLS = 1 << 18  # words of the windows that are transformed at a time


def _reduced(x: np.ndarray) -> np.ndarray:
    """Remainders of integers below 2 ** 53; some are one modulus off."""
    return x - np.floor(x * (1.0 / MODULUS)) * MODULUS


@cache
def _root_powers(size: int, inverse: bool) -> np.ndarray:
    """The ``size`` powers of a root of unity of that order."""
    root = pow(GENERATOR, (MODULUS - 1) // size, MODULUS)
    root = pow(root, -1, MODULUS) if inverse else root
    return np.array([pow(root, k, MODULUS) for k in range(size)], np.float64)


@cache
def _matrix(size: int, inverse: bool) -> np.ndarray:
    k = np.arange(size)
    return _root_powers(size, inverse)[np.outer(k, k) % size]


@cache
def _parted(size: int, inverse: bool) -> tuple[int, int, np.ndarray]:
    """Rows and columns of a long transform and the twiddle factors between its two steps."""
    rows = 1 << (size.bit_length() - 1) // 2
    columns = size // rows
    return rows, columns, _root_powers(size, inverse)[np.outer(np.arange(rows), np.arange(columns)) % size]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row, in an order that ``back`` undoes; ``inverse`` takes the inverse root."""
    size = x.shape[1]
    if size <= DENSE:
        return _reduced(x @ _matrix(size, inverse))
    rows, columns, twiddle = _parted(size, inverse)
    x = _reduced(_matrix(rows, inverse) @ x.reshape(-1, rows, columns))
    x = _reduced(x * twiddle)
    return _reduced(x.reshape(-1, columns) @ _matrix(columns, inverse)).reshape(-1, size)


def back(x: np.ndarray) -> np.ndarray:
    """The rows whose transforms are given, as least remainders."""
    size = x.shape[1]
    if size <= DENSE:
        x = _reduced(x @ _matrix(size, True))
    else:
        rows, columns, twiddle = _parted(size, True)
        x = _reduced(x.reshape(-1, columns) @ _matrix(columns, True)).reshape(-1, rows, columns)
        x = _reduced(_matrix(rows, True) @ _reduced(x * twiddle)).reshape(-1, size)
    x = _reduced(x * pow(size, -1, MODULUS))
    x[x < 0] += MODULUS
    x[x >= MODULUS] -= MODULUS
    return x


def _spread(first: np.ndarray, count: np.ndarray, step: int) -> np.ndarray:
    """first, first + step, ... with ``count`` numbers for each entry."""
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + within * step


def seeds(ids: np.ndarray, first: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of all occurrences of a scale's blocks at its distances, by distance and start.

    ``first`` are the first words of the texts and the end of the last. Codes are small hashes of the words, so a few
    occurrences are none; none is missed.
    """
    block = min(scale, LONGEST)
    least = 1 if scale == SMALLEST else scale
    begin, end = first[:-1], first[1:]
    long_enough = end - begin >= max(LEAST, TIMES * least)
    begin, end = begin[long_enough], end[long_enough]
    count = (end - begin - least - block) // scale + 1
    starts, ends = _spread(begin, count, scale), np.repeat(end, count)
    codes = (mixed(ids.astype(np.uint64)) % np.uint64(isqrt((MODULUS - 1) // block))).astype(np.float64)
    codes = np.concatenate([codes, np.zeros(2 * scale + 2 * block)])
    squares = np.concatenate([[0.0], np.cumsum(codes * codes)])
    at, distances = [], []
    some = max(1, CELLS // (2 * block))
    for low in range(0, len(starts), some):
        here, limit = starts[low : low + some], ends[low : low + some]
        pattern = np.zeros((len(here), 2 * block))
        pattern[:, :block] = codes[here[:, None] + np.arange(block)]
        pattern = transform(pattern, inverse=True)
        own = squares[here + block] - squares[here]
        for offset in range(least, 2 * scale, block):
            window = codes[(here + offset)[:, None] + np.arange(2 * block)]
            shared = back(_reduced(transform(window) * pattern))[:, :block]
            place = (here + offset)[:, None] + np.arange(block)
            differences = own[:, None] + squares[place + block] - squares[place] - 2 * shared
            row, shift = np.nonzero((differences == 0) & (place + block <= limit[:, None]))
            at.append(here[row])
            distances.append(shift + offset)
    at, distances = np.concatenate([*at, np.zeros(0, np.int64)]), np.concatenate([*distances, np.zeros(0, np.int64)])
    order = np.lexsort((at, distances))
    return at[order], distances[order]


def _agreeing(ids: np.ndarray, at: int, distance: int, limit: int, step: int) -> int:
    """First place from ``at`` in direction ``step`` whose word differs from the one a distance on; else ``limit``."""
    size = 64
    while at != limit:
        stop = min(at + size, limit) if step > 0 else max(at - size, limit)
        low, high = (at, stop) if step > 0 else (stop + 1, at + 1)
        differ = np.flatnonzero(ids[low:high] != ids[low + distance : high + distance])
        if len(differ):
            return low + int(differ[0] if step > 0 else differ[-1])
        at, size = stop, size * 2
    return limit


def runs_of(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, period) of the runs of all texts, by begin and period.

    Smaller periods come first, so an interval that is found again has one of their multiples.
    """
    found: dict[tuple[int, int], int] = {}
    longest = int(np.diff(first).max(initial=0))
    scale = SMALLEST
    while longest >= max(LEAST, TIMES * scale) or scale == SMALLEST:
        block = min(scale, LONGEST)
        at, distances = seeds(ids, first, scale)
        keep = ~_inside(at, at + distances + block, [run for run in found.items() if run[1] <= block])
        at, distances = at[keep], distances[keep]
        text = np.searchsorted(first, at, "right") - 1
        known = distance_before = -1
        for start, distance, low, high in zip(at.tolist(), distances.tolist(), first[text].tolist(), first[text + 1].tolist()):
            if distance != distance_before:
                known, distance_before = -1, distance
            if start + distance + block <= known:
                continue
            if (ids[start : start + block] != ids[start + distance : start + distance + block]).any():
                continue
            begin = _agreeing(ids, start - 1, distance, low - 1, -1) + 1
            known = end = _agreeing(ids, start + block, distance, high - distance, 1) + distance
            if end - begin >= max(LEAST, TIMES * distance):
                found.setdefault((begin, end), distance)
        scale *= 2
    return sorted((begin, end, period) for (begin, end), period in found.items())


def _inside(begin: np.ndarray, end: np.ndarray, runs: list[tuple[tuple[int, int], int]]) -> np.ndarray:
    """Which stretches lie in a run. With a block as long as its period, such a stretch has no other period."""
    if not runs:
        return np.zeros(len(begin), bool)
    spans = np.array(sorted(span for span, _ in runs))
    reach = np.maximum.accumulate(spans[:, 1])
    before = np.searchsorted(spans[:, 0], begin, "right") - 1
    return (before >= 0) & (reach[before] >= end)


def _found(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs (start, length, period) and collapsed text of each text."""
    words = [text.encode().split() if text else [] for text in texts]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = [word for text in words for word in text]
    ids = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    dropped = np.zeros(len(flat), bool)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for begin, end, period in runs_of(ids, first):
        text = int(np.searchsorted(first, begin, "right")) - 1
        runs[text].append((begin - int(first[text]), end - begin, period))
        dropped[begin + period : end] = True
    for number, text in enumerate(words):
        left = text
        if runs[number]:
            left = [word for word, gone in zip(text, dropped[first[number] : first[number + 1]].tolist()) if not gone]
        yield len(text), runs[number], b" ".join(left)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        counts, runs, collapsed = zip(*_found(batch.column("text").to_pylist()))
        found = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in runs]
        columns = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(found, _RUNS)]
        columns.append(pa.array([text.decode() for text in collapsed], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row of ``docs``.

    Words are parted by ASCII blanks; case counts. A run (start, length, period) is a stretch of consecutive words,
    numbered from 0, in which words a period apart are equal; the period is its smallest, the length at least
    ``LEAST`` words and ``TIMES`` periods, and no neighbouring word extends it. Runs are ordered by start and period
    and may overlap. ``collapsed`` are the words that lie in no run or in the first period of each run that holds
    them, joined by one blank.

    Null and empty texts have no words, an empty list of runs and an empty collapsed text. Each row is a document of
    its own, also if rows repeat or the id is null. No other column is read, so names cannot clash. An empty table
    gives an empty result. One scan, no shuffle; a text is handled as a whole by one task.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_scan, schema)
