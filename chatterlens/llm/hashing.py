"""Hashes of words and word windows of whole Arrow batches, with numpy instead of a loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 18  # of text at a time; arrays of numbers over it take many times that

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[0] = 0
_PLACES = np.random.default_rng(2).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def byte_classes(word_byte) -> np.ndarray:
    """Table from byte to lower-cased byte of a word, or 0 for bytes that part words.

    A zero byte that is part of a word becomes 255, which UTF-8 never has.
    """
    lowered = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return np.array([(b or 255) if word_byte(b) else 0 for b in lowered], np.uint8)


ALPHANUMERIC = byte_classes(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
BLANK_SEPARATED = byte_classes(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising step of splitmix64, so that low and high bits alike are usable."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BATCH_BYTES)
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])
            for base in (_BASE, _BASE_INVERSE)
        )
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of a batch of texts: byte spans in ``data``, hashes, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, and the end of the last
    text_starts: np.ndarray  # byte offsets of the texts, and the end of the last

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``length`` words, and whether it lies within one text."""
        n = max(0, len(self.hashes) - length + 1)
        total = np.full(n, length, np.uint64)
        for j in range(length):
            total += self.hashes[j : j + n] * _PLACES[j]
        text = self.text_of_word()
        return mixed(total), text[:n] == text[length - 1 : length - 1 + n]

    def whole(self, text: int) -> np.uint64:
        """Hash of all words of a text that is shorter than a window."""
        words = self.hashes[self.first[text] : self.first[text + 1]]
        total = np.uint64(len(words)) + (words * _PLACES[: len(words)]).sum(dtype=np.uint64)
        return mixed(np.array([total], np.uint64))[0]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts and their offsets; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, classes: np.ndarray) -> Words:
    data, offsets = text_buffers(texts)
    low = classes[data]
    inside = low != 0
    nonempty = offsets[:-1][np.diff(offsets) > 0]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[nonempty] = inside[nonempty]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[nonempty[1:] - 1] = inside[nonempty[1:] - 1]
    starts = np.flatnonzero(begins)
    if len(starts):
        up, down = powers_up_to(len(data))
        hashes = mixed(np.add.reduceat(_BYTES[low] * up, starts) * down[starts])
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, starts, np.flatnonzero(ends) + 1, hashes, np.searchsorted(starts, offsets), offsets)


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has about ``BATCH_BYTES`` of text, or one row. Empty batches are left out."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(lengths)]
        for begin, end in zip(cuts, cuts[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)


def as_long(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return hashes.view(np.int64)
