"""Alignment of two tokenizers by the byte offsets where tokens of both end.

Both encodings are made of the same bytes, so a token is known by the byte at which it ends. Each encoding has a
dictionary from end to token index; the hash sets of the ends are intersected, and the sorted common ends cut both id
lists into groups. Inside a group the tokens of both sides that overlap are linked.

A blank between two characters that are no white space begins a token in both encodings, so groups never reach beyond
it: texts are cut there into pieces, and each worker aligns a piece once and keeps the result in its cache. Links are
counted over all documents by their pair of ids, with a map-side combine, and joined back as sums for each document.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatterlens.llm.hashing import slices
from chatterlens.llm.steps import lasting, stored, temporary

CACHED = 1 << 18  # pieces that a worker keeps, and as many from before
SHORT = 64  # characters of a piece that is kept
ID_BITS = 20
BROADCAST_PAIRS = 1_000_000  # rows of three numbers

_CUT = re.compile(r"(?<=\S)(?= \S)")
BLANK = "▁"  # how pieces spell a blank

#: Bytes that the byte-level alphabet spells as the character of the same number; all others follow from 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> dict[str, int]:
    """Characters of the byte-level alphabet to bytes."""
    others = [b for b in range(256) if b not in _PLAIN]
    return {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces(text: str) -> list[str]:
    """A blank and the text, cut before single blanks between other characters; joined they are the whole."""
    return _CUT.split(" " + text)


class Aligner:
    """Both tokenizers with the bytes of their tokens, and a cache of aligned pieces."""

    def __init__(self, byte_level: str, by_piece: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_str(byte_level)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(alphabet[c] for c in token) if set(token) <= alphabet.keys() else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=by_piece)
        self.b_bytes = [self._bytes_of_piece(number) for number in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(part) for part in parts]) for parts in (self.a_bytes, self.b_bytes))
        #: Ids as they stand in the text of groups: before another id of their side, and at their side's end.
        self.a_names, self.b_names = (
            [f"{number}{mark}" for number in range(size) for mark in marks]
            for size, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
        )
        #: Aligned pieces since ``before`` was full, and those of the time before that are not met again yet.
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def _bytes_of_piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        if BLANK in piece.lstrip(BLANK):
            raise ValueError(f"the piece {piece!r} reaches over a blank")
        return piece.replace(BLANK, " ").encode()

    def aligned(self, texts: list[str | None]) -> list[list[tuple] | None]:
        """The aligned pieces of each text; None for one without tokens."""
        cut = [pieces(text) if text else None for text in texts]
        new = set().union(*filter(None, cut)).difference(self.known)
        again = new & self.before.keys()
        self.known.update((piece, self.before[piece]) for piece in again)
        fresh = list(new - again)
        a = [found.ids for found in self.a.encode_batch_fast(fresh, add_special_tokens=False)]
        b = self.b.encode([piece[1:] for piece in fresh], num_threads=1)
        if not self._all_whole(fresh, a, b):
            self.known.update(dict.fromkeys(fresh))
            whole = [self._all_whole(*([one] for one in found)) for found in zip(fresh, a, b)]
            fresh, a, b = (list(compress(column, whole)) for column in (fresh, a, b))
        self.known.update(zip(fresh, self._align(a, b)))
        found = [parts and list(map(self.known.__getitem__, parts)) for parts in cut]
        for piece in new:
            if len(piece) > SHORT:
                del self.known[piece]
        if len(self.known) > CACHED:
            self.known, self.before = {}, self.known
        return [None if parts is None or None in parts else parts for parts in found]

    def _all_whole(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether the bytes of both encodings are those of the texts."""
        sizes = np.array([len(text.encode()) for text in texts], np.int64)
        for parts, lengths, ids in ((self.a_bytes, self.a_sizes, a), (self.b_bytes, self.b_sizes, b)):
            flat = list(chain.from_iterable(ids))
            ends = np.cumsum([len(one) for one in ids], dtype=np.int64)
            totals = np.append(0, np.cumsum(lengths[flat] if flat else []))[ends]
            if not np.array_equal(totals, np.cumsum(sizes)) or b"".join([parts[number] for number in flat]) != "".join(texts).encode():
                return False
        return True

    def _align(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple]:
        """Number of ids of both, groups and links, the groups as text, and the linked pairs as 8-byte numbers, of
        each of many pieces. Their bytes follow each other, so one pair of dictionaries has the ends of all."""
        a_ids, b_ids = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_index, b_index = ({end: at for at, end in enumerate(ends.tolist(), 1)} for ends in (a_ends, b_ends))
        common = sorted(a_index.keys() & b_index.keys())
        a_cuts, b_cuts = (np.array([index[end] for end in common], np.int64) for index in (a_index, b_index))

        # Every end of either side ends the bytes that one token of each side share: a link.
        linked = np.union1d(a_ends, b_ends)
        pairs = a_ids[np.searchsorted(a_ends, linked)] << ID_BITS | b_ids[np.searchsorted(b_ends, linked)]

        # A's ids of a group, then B's: their places in the order in which the groups are written.
        a_names, b_names = a_ids * 2, b_ids * 2
        a_names[a_cuts - 1] += 1
        b_names[b_cuts - 1] += 1
        a_group, b_group = (np.searchsorted(cuts, np.arange(len(ids)), "right") for cuts, ids in ((a_cuts, a_ids), (b_cuts, b_ids)))
        before_a, before_b = np.append(0, b_cuts)[a_group], a_cuts[b_group] if len(b_ids) else b_group
        written = [""] * (len(a_ids) + len(b_ids))
        for place, code in zip((np.arange(len(a_ids)) + before_a).tolist(), a_names.tolist()):
            written[place] = self.a_names[code]
        for place, code in zip((np.arange(len(b_ids)) + before_b).tolist(), b_names.tolist()):
            written[place] = self.b_names[code]

        a_counts, b_counts = (np.array([len(ids) for ids in side], np.int64) for side in (a, b))
        a_to, b_to = np.cumsum(a_counts), np.cumsum(b_counts)
        ends = a_ends[a_to - 1] if len(a) else a_to
        n_groups, n_links = (np.diff(np.searchsorted(places, ends, "right"), prepend=0) for places in (common, linked))
        w, packed = 0, pairs.tobytes()
        at = 0
        for n_a, n_b, groups, links in zip(a_counts.tolist(), b_counts.tolist(), n_groups.tolist(), n_links.tolist()):
            yield n_a, n_b, groups, links, "".join(written[w : w + n_a + n_b]), packed[at : at + 8 * links]
            w, at = w + n_a + n_b, at + 8 * links


# One cache for each worker process, shared by the tasks that it runs with the same files.
_worker: dict[tuple[int, int], Aligner] = {}

_SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]


def _scanner(files) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(map(hash, files.value))
        if key not in _worker:
            _worker.clear()
            _worker[key] = Aligner(*files.value)
        for batch in slices(batches, "text"):
            counts, groups, pairs, times = [], [], [], []
            for parts in _worker[key].aligned(batch.column("text").to_pylist()):
                *numbers, text, linked = zip(*parts) if parts else ((), (), (), (), (), ())
                counts.append([sum(n) for n in numbers])
                groups.append("".join(text)[:-1])
                distinct, n = np.unique(np.frombuffer(b"".join(linked), np.int64), return_counts=True)
                pairs.append(distinct)
                times.append(n)
            columns = [pa.array(column, pa.int64()) for column in zip(*counts)]
            columns += [pa.array(groups, pa.string()), _lists(pairs), _lists(times)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *_NAMES])

    return run


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays).astype(np.int64)))


def align(docs: DataFrame, byte_level: str, by_piece: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row of ``docs``.

    A is a blank and the text by the byte-level tokenizer file, B the text by the model of pieces, which adds the
    blank itself; strings of special tokens are text like any other. ``groups`` lists the ids of both sides between
    common ends, as in ``a1,a2|b1;a3|b2,b3``. Links are all occurrences of an A and a B token whose bytes overlap;
    ``pairs`` are their distinct ids, A shifted by ``ID_BITS`` and B, each ``times`` in the text.

    Null and empty texts, and those of which one encoding does not give back a blank and the text, have zeros, an
    empty text of groups and empty lists. Each row is a document of its own, also if rows repeat or the id is null.
    Other columns are not read. An empty table gives an empty result. One scan, no shuffle.
    """
    files = docs.sparkSession.sparkContext.broadcast((Path(byte_level).read_text(), Path(by_piece).read_bytes()))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_scanner(files), f"id {rows.schema['id'].dataType.simpleString()}, {_SCHEMA}")


def link_counts(links: DataFrame) -> DataFrame:
    """(pair, count, best) of links (pair, times): its links in all documents, and whether no A id has more for its B id."""
    counts = stored(links.groupBy("pair").agg(F.sum("times").alias("count")), "link-counts")
    b = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    joined = counts.withColumn("b", b).join(F.broadcast(highest), "b")  # as many rows as B has ids at most
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def with_link_scores(aligned: DataFrame) -> DataFrame:
    """Rows of ``align`` with ``n_best`` and ``count_sum`` instead of the pairs.

    A link's count is the number of links of all rows that have its pair of ids. ``n_best`` counts a row's links whose
    count is the highest of their B id, ties included; ``count_sum`` is the sum of the counts of its links. Rows
    without links have zeros. The counts are broadcast up to ``BROADCAST_PAIRS`` rows, else joined by a shuffle.
    """
    with temporary(aligned.sparkSession):
        kept = stored(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned")
        links = kept.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("__row", "link.pairs", "link.times")
        links = links.withColumnRenamed("pairs", "pair")
        counts = stored(link_counts(links), "link-counts")
        counts = F.broadcast(counts) if counts.count() <= BROADCAST_PAIRS else counts
        best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
        sums = links.join(counts, "pair").groupBy("__row").agg(best, F.sum(F.col("times") * F.col("count")).alias("count_sum"))
        found = kept.drop("pairs", "times").join(sums, "__row", "left").drop("__row")
        return lasting(found.fillna(0, ["n_best", "count_sum"]), "link-scores")
