"""Byte-level BPE with Spark's higher-order functions: ranked merges folded over the bytes of distinct words.

Texts are cut into words by the tokenizer's pattern. A word that is a token is its id; any other begins as the ids of
its bytes, and a fold merges the leftmost pair of least rank until no neighbours make a token. The frequent words of
the corpus are folded once each; a table of their ids and of all tokens answers most words of a text by look-up, and
the remaining words are folded where they stand. The most frequent words of all are looked up in a small table first,
which a processor's cache holds. Occurrences of words are never shuffled.

Words reach the expressions as literals, hashed into many small maps, since a look-up in a map reads its entries one by
one; pairs of ids as an array at places that no two pairs share. Session variables make such literals without an
expression for each entry.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.llm.steps import kth_largest, stored, temporary

FREQUENT = 400_000  # distinct words in the look-up table, besides the tokens
HOT = 8_192  # words in the table that is read first
ID_BITS = 18
PLACE_BITS = 27  # of a part in its word
ABOVE = ID_BITS + PLACE_BITS  # bits of a part below its rank
MASK = (1 << ID_BITS) - 1  # of an id, or the rank where no pair is
BUCKETS = 65_521  # of pairs of ids that are shifted together
FREE = 1 << 60  # a place without a pair, unlike all of them
WORD_SLOTS = 524_287
HOT_SLOTS = 16_381
NO_BYTE = "\u0100"  # the first character that is no byte


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, which are the ranks of the merges."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """Pairs of ids, as one number each, to the id of their joint bytes."""
    merged = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                merged[left << ID_BITS | right] = rank
    return merged


def _placed(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Shifts of buckets of pairs, and the pairs with their ranks at places that no two of them share.

    A pair is at its number and its bucket's shift, modulo the places. Two pairs of a bucket differ modulo the places,
    since these and the buckets have no common divisor and as product more than any number of a pair.
    """
    places = max(5 * len(pairs) // 2, max(pairs, default=0) // BUCKETS) + 1
    while places % BUCKETS == 0:
        places += 1
    buckets: dict[int, list[int]] = {}
    for pair in pairs:
        buckets.setdefault(pair % BUCKETS, []).append(pair)
    shifts, entries = np.zeros(BUCKETS, np.int64), [FREE] * places
    for bucket, members in sorted(buckets.items(), key=lambda one: -len(one[1])):
        at = next(shift for shift in range(places) if all(entries[(pair + shift) % places] == FREE for pair in members))
        shifts[bucket] = at
        for pair in members:
            entries[(pair + at) % places] = pair << ID_BITS | pairs[pair]
    return shifts, np.array(entries, np.int64)


@contextmanager
def _literals(*rows: DataFrame) -> Iterator[dict[str, Column]]:
    """The columns of tables of one row, which expressions made inside take as literals."""
    names = {name: f"chatterlens_{name}_{uuid.uuid4().hex}" for row in rows for name in row.columns}
    spark = rows[0].sparkSession
    try:
        for row in rows:
            for name in row.columns:
                spark.sql(f"DECLARE VARIABLE {names[name]} {row.schema[name].dataType.simpleString()}")
                spark.sql(f"SET VAR {names[name]} = (SELECT {name} FROM {{row}})", row=row)
        yield {name: F.expr(variable) for name, variable in names.items()}
    finally:
        for variable in names.values():
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {variable}")


def _bytes_of(word: Column) -> Column:
    """The bytes of a string as characters of the same numbers."""
    return F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")


def folded(word: Column, table: dict[str, Column]) -> Column:
    """Ids of a word that is no token; ``table`` has the ``single`` parts of bytes and the ``merges``.

    The state is one number for each part of the word: the rank of the part joined with the next one, the part's place
    among the parts and its id. The least number is the leftmost pair of least rank, and says where it is.
    """
    mask, places, above = MASK, (1 << PLACE_BITS) - 1 << ID_BITS, ABOVE
    one_place, no_pair = 1 << ID_BITS, MASK << ABOVE
    shifts, entries = table["merges"]["shifts"], table["merges"]["entries"]

    def part(token: Column, place: Column, following: Column) -> Column:
        pair = F.shiftleft(token, ID_BITS).bitwiseOR(following)
        shift = F.get(shifts, (pair % BUCKETS).cast("int"))
        entry = F.get(entries, ((pair + shift) % F.size(entries)).cast("int"))
        rank = F.least(entry.bitwiseXOR(F.shiftleft(pair, ID_BITS)), F.lit(mask).cast("long"))  # a null is left out
        return F.shiftleft(rank, above).bitwiseOR(place).bitwiseOR(token)

    def merged(parts: Column, least: Column, at: Column) -> Column:
        token = F.shiftright(least, above)

        def joined(one: Column, place: Column) -> Column:
            here = part(token, least.bitwiseAND(places), F.get(parts, at + 2).bitwiseAND(mask))
            before = part(one.bitwiseAND(mask), one.bitwiseAND(places), token)
            return F.when(place > at, one - one_place).when(place == at, here).when(place == at - 1, before).otherwise(one)

        return F.transform(F.array_remove(parts, F.get(parts, at + 1)), joined)

    def step(parts: Column, _: Column) -> Column:
        def merge(at: Column) -> Column:
            least = F.get(parts, at)
            return F.when(least >= no_pair, parts).otherwise(merged(parts, least, at))

        return _let(F.shiftright(F.array_min(parts).bitwiseAND(places), ID_BITS).cast("int"), merge)

    def begun(numbers: Column) -> Column:
        def first(byte: Column, place: Column) -> Column:
            following = F.coalesce(F.get(numbers, place + 1), F.lit(256))
            return F.get(table["single"], byte * 257 + following).bitwiseOR(F.shiftleft(place.cast("long"), ID_BITS))

        return F.transform(numbers, first)

    rounds = F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))
    return F.aggregate(rounds, _let(F.transform(_bytes_of(word), F.ascii), begun), step, lambda parts: F.transform(parts, lambda x: x.bitwiseAND(mask).cast("int")))


def words_of(text: Column, pattern: str) -> Column:
    """All matches of the pattern in order; blanks and letters are those of Unicode."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def _slot_of(word: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(slots)).cast("int")


def _word_table(words: DataFrame, name: str, slots: int) -> DataFrame:
    """One row with the words under a ``name``: a list of maps from word to ids; a word is in the map of its slot."""
    entry, slot_of = F.struct("word", "ids"), _slot_of(F.col("word"), slots).cast("long")
    held = words.groupBy(slot_of.alias("slot")).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    every = words.sparkSession.range(slots).withColumnRenamed("id", "slot").join(held, "slot", "left")
    by_slot = F.array_sort(F.collect_list(F.struct("slot", "held")), lambda one, two: F.signum(one["slot"] - two["slot"]).cast("int"))
    return every.agg(F.transform(by_slot, lambda slot: slot["held"]).alias(name))


def _found(word: Column, held: Column, slots: int) -> Column:
    return F.try_element_at(F.get(held, _slot_of(word, slots)), word)


class Vocabulary:
    """The tables of a rank file, made on the driver. Their size is that of the file."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        if max(self.ranks.values()) >= MASK:
            raise ValueError(f"ids of {path} need more than {ID_BITS} bits")
        self.single = [self._first_part(byte, following) for byte in range(256) for following in range(257)]
        self.shifts, self.entries = _placed(_pairs(self.ranks))

    def _first_part(self, byte: int, following: int) -> int:
        """Rank of a byte joined with the following one, which is 256 at the end, and the byte's id."""
        joint = bytes([byte, following]) if following < 256 else b""
        return self.ranks.get(joint, MASK) << ABOVE | self.ranks[bytes([byte])]

    def table(self, spark: SparkSession) -> DataFrame:
        """One row with the ``single`` parts of bytes, by the byte and the following one, and the ``merges``."""
        numbers = pa.list_(pa.int64())
        kind = pa.struct({"shifts": numbers, "entries": numbers})
        merges = pa.array([{"shifts": self.shifts, "entries": self.entries}], kind)
        return spark.createDataFrame(pa.table({"single": pa.array([self.single], numbers), "merges": merges}))

    def tokens(self, spark: SparkSession) -> DataFrame:
        """(word, ids) of the tokens that are strings by themselves."""
        words, ids = [], []
        for token, rank in self.ranks.items():
            try:
                words.append(token.decode())
                ids.append([rank])
            except UnicodeDecodeError:
                continue
        return spark.createDataFrame(pa.table({"word": words, "ids": pa.array(ids, pa.list_(pa.int32()))}))

    def pieces(self, spark: SparkSession) -> DataFrame:
        """One row with the ``pieces`` by id, bytes as characters of the same numbers."""
        pieces: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            pieces[rank] = token.decode("ISO-8859-1")
        return spark.createDataFrame(pa.table({"pieces": pa.array([pieces], pa.list_(pa.string()))}))


@cache
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str, pattern: str) -> DataFrame:
    """(word, ids, hot) of all tokens and of up to ``FREQUENT`` of the most frequent other words of all documents; up to
    ``HOT`` of the most frequent of both are hot.

    Counted with a map-side combine; the least counts come from distributed selections, so neither the driver nor a
    task gets more than the table's rows. Which words are in the table decides speed only.
    """
    spark = docs.sparkSession
    tokens = vocabulary.tokens(spark)
    words = docs.select(F.explode(words_of(F.col(f"`{text}`"), pattern)).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").cast("double").alias("n")).where("n > 1")
    counted = stored(counted.join(F.broadcast(tokens), "word", "left"), "words")
    others = counted.where("ids IS NULL")
    found = others.where(F.col("n") > F.lit(kth_largest(others, "n", FREQUENT + 1))).repartition("word")
    hot = F.col("n") > F.lit(kth_largest(counted, "n", HOT + 1))
    unused = tokens.join(counted.where("ids IS NOT NULL"), "word", "left_anti").select("word", "ids", F.lit(False).alias("hot"))
    with _literals(vocabulary.table(spark)) as table:
        folds = found.select("word", folded(F.col("word"), table).alias("ids"), hot.alias("hot"))
        return folds.union(counted.where("ids IS NOT NULL").select("word", "ids", hot.alias("hot"))).union(unused)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of every row of ``docs``: token ids of the whole text by the rank file at ``path``.

    Each match of ``pattern`` is encoded by itself; strings of special tokens are text like any other. Null and empty
    texts have no ids. Each row is a document of its own, also if rows repeat or the id is null. Other columns are not
    read. An empty table gives an empty result.
    """
    spark, vocabulary = docs.sparkSession, vocabulary_of(path)
    with temporary(spark):
        words = stored(frequent_words(docs, vocabulary, text, pattern), "frequent-words")
        tables = _word_table(words.where("hot"), "hot", HOT_SLOTS), _word_table(words, "words", WORD_SLOTS)
        with _literals(vocabulary.table(spark), *tables) as table:

            def encoded(word: Column) -> Column:
                hot, known = _found(word, table["hot"], HOT_SLOTS), _found(word, table["words"], WORD_SLOTS)
                return F.coalesce(hot, known, folded(word, table))

            cut = words_of(F.col(f"`{text}`"), pattern)
            return docs.select(F.col(f"`{key}`").alias("id"), F.flatten(F.transform(cut, encoded)).alias("ids"))


def joined_ids(ids: Column) -> Column:
    """The ids as decimal numbers with a blank between; JSON has them without a string for each."""
    return F.trim(F.replace(F.to_json(ids), F.lit(","), F.lit(" ")), F.lit("[]"))


def decoded(ids: Column, pieces: Column) -> Column:
    """The bytes of token ids by the ``pieces``, joined as characters and turned into bytes once for a text.

    Null if one of the ids has no bytes.
    """
    parts = F.transform(ids, lambda one: F.get(pieces, one))
    missing = F.lit(NO_BYTE)
    return _let(
        F.array_join(parts, "", NO_BYTE),
        lambda joined: F.when(~F.contains(joined, missing), F.encode(joined, "ISO-8859-1")),
    )


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes of their ids; null for null ids or such that the file has not."""
    with _literals(vocabulary_of(path).pieces(tokens.sparkSession)) as table:
        return tokens.withColumn("decoded", decoded(F.col(f"`{ids}`"), table["pieces"]))
