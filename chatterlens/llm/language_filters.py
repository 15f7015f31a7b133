"""Language identification by n-gram filters that return all languages of an n-gram at once.

Each language has the n-grams of letters that enough of its training documents contain. They are entered in one table
of ``SLOTS`` language bitmasks, at the ``HASHES`` places of their hash: a Bloom filter for every language, sliced so
that one look-up (the bits common to all places) gives every language that has the n-gram. A text's hits per language
are the popcounts over its n-grams; the hits that the filter's fill lets expect by chance are taken off; the language
with the most hits left is the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm.hashing import mixed, slices

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
HASHES = 2
LENGTHS = (2, 3, 4)
MAX_DOCUMENTS = 5000
LEAST_SHARE = 0.01
UNDETERMINED = "und"
_PLACES = mixed(np.arange(11, 11 + max(LENGTHS), dtype=np.uint64)) | np.uint64(1)


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def n_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of lower-cased words with their edges, the number of each one's text, and which texts
    have letters."""
    lowered = ["" if text is None else text.lower() for text in texts]
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(lowered)), [len(text) + 1 for text in lowered])
    codes = np.where(letters()[codes], codes, 0)
    lettered = np.bincount(rows[codes != 0], minlength=len(lowered)) > 0
    # One edge between words; the last edge of a text counts as the first of the next.
    kept = np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])
    codes, rows = np.concatenate([[0], codes[kept]]).astype(np.uint64), np.concatenate([[0], rows[kept]])
    hashes, owners = [], []
    for length in LENGTHS:
        n = max(0, len(codes) - length + 1)
        total = np.full(n, length, np.uint64)
        for j in range(length):
            total += codes[j : j + n] * _PLACES[j]
        inner = np.ones(n, bool)
        for j in range(1, length - 1):
            inner &= codes[j : j + n] != 0
        if length == 2:
            inner &= (codes[:n] != 0) | (codes[1 : 1 + n] != 0)
        hashes.append(mixed(total[inner]))
        owners.append(rows[1 : 1 + n][inner])
    return np.concatenate(hashes), np.concatenate(owners), lettered


def slots_of(hashes: np.ndarray) -> list[np.ndarray]:
    """The places of each n-gram in the table."""
    return [(hashes >> np.uint64(64 - SLOT_BITS * (i + 1))) & np.uint64(SLOTS - 1) for i in range(HASHES)]


@dataclass
class Filters:
    """Languages, most frequent first, and a plane of bitmasks for every eight of them."""

    languages: list[str]
    planes: list[np.ndarray]

    @classmethod
    def of(cls, languages: list[str], grams: list[np.ndarray]) -> Filters:
        planes = [np.zeros(SLOTS, np.uint8) for _ in range(-(-len(languages) // 8))]
        for number, own in enumerate(grams):
            for slots in slots_of(own):
                planes[number // 8][slots] |= np.uint8(1 << number % 8)
        return cls(languages, planes)

    def chance(self) -> np.ndarray:
        """Share of n-grams of no language that each language's filter returns."""
        fill = [(plane >> bit & 1).mean() for plane in self.planes for bit in range(8)]
        return np.array(fill[: len(self.languages)]) ** HASHES

    def hits(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """n-grams of each text that each language's filter returns."""
        places = slots_of(hashes)
        found = []
        for plane in self.planes:
            mask = plane[places[0]]
            for more in places[1:]:
                mask = mask & plane[more]
            counts = np.bincount(rows * 256 + mask, minlength=256 * n).reshape(n, 256)
            found += [counts @ (np.arange(256) >> bit & 1) for bit in range(8)]
        return np.column_stack(found)[:, : len(self.languages)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        hashes, rows, lettered = n_grams(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        chance = self.chance()
        total = np.bincount(rows, minlength=len(texts))
        corrected = np.maximum(0, (self.hits(hashes, rows, len(texts)) - total[:, None] * chance) / np.maximum(1 - chance, 1e-9))
        best = corrected.argmax(axis=1)
        score = corrected.max(axis=1) / np.maximum(corrected.sum(axis=1), 1e-300)
        names = [self.languages[i] if some else UNDETERMINED for i, some in zip(best, lettered)]
        return names, np.where(lettered, np.minimum(score, 1.0), 0.0)


def _document_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (lang, text) to (lang, gram, documents) of each slice."""
    for batch in slices(batches, "text"):
        hashes, rows, _ = n_grams(batch.column("text").to_pylist())
        langs = np.array(batch.column("lang").to_pylist(), object)
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        first = np.ones(len(hashes), bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        hashes, owner = hashes[first], langs[rows[first]]
        for lang in set(langs):
            grams, documents = np.unique(hashes[owner == lang], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(documents, pa.int64())],
                names=["lang", "gram", "documents"],
            )


def learn(docs: DataFrame, training: Column, key: str, text: str, lang: str) -> Filters:
    """Filters from up to about ``MAX_DOCUMENTS`` training documents of each language, chosen by a hash of the id.

    A language has the n-grams of at least ``LEAST_SHARE`` of its documents and of at least two (one, if it has but
    one document): at most a bounded number, whatever the size of the corpus.
    """
    spark = docs.sparkSession
    rows = docs.where(training & F.col(lang).isNotNull()).select(F.xxhash64(key).alias("hash"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = [(row["lang"], row["count"]) for row in rows.groupBy("lang").count().collect()]
    if not sizes:
        return Filters([], [])
    shares = [(lang, int(min(1.0, MAX_DOCUMENTS / n) * 1_000_000)) for lang, n in sizes]
    share = F.broadcast(spark.createDataFrame(shares, "shared_lang string, share int"))
    sample = rows.join(share, F.col("lang") == F.col("shared_lang")).where(F.pmod("hash", F.lit(1_000_000)) < F.col("share"))
    counted = sample.select("lang", "text").mapInArrow(_document_grams, "lang string, gram long, documents long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("documents").alias("documents"))
    least = [(lang, float(max(min(2, n), LEAST_SHARE * min(n, MAX_DOCUMENTS)))) for lang, n in sizes]
    least = F.broadcast(spark.createDataFrame(least, "shared_lang string, least double"))
    frequent = counted.join(least, F.col("lang") == F.col("shared_lang")).where("documents >= least").select("lang", "gram")
    languages = [lang for lang, n in sorted(sizes, key=lambda pair: (-pair[1], pair[0]))]
    grams: dict[str, list[int]] = {lang: [] for lang in languages}
    for row in frequent.collect():
        grams[row.lang].append(row.gram)
    return Filters.of(languages, [np.array(grams[lang], np.int64).view(np.uint64) for lang in languages])


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Add lang_pred and score to every document; other columns of these names are replaced.

    ``und`` with score 0 for null texts and texts without letters, or if no language was learned. The score is the
    language's share of all corrected hits; without hits the most frequent language is given with score 0, and of
    equal ones the more frequent. Whole texts are used; repeated rows are judged alike.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(_identifier(shared, text), T.StructType([*docs.schema.fields, *added]))


def _identifier(filters, text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            names, score = filters.value.predict(batch.column(text).to_pylist())
            yield batch.append_column("lang_pred", pa.array(names, pa.string())).append_column("score", pa.array(score, pa.float64()))

    return run
