"""Approximate nearest neighbours by a permutation index, for the largest inner product.

A vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots, in order, and posted with the pivots' ranks in
their inverted files. The files of a query's own nearest pivots give the footrule distance of the two orders to every
vector posted there (a pivot missing in one order counts as its rank ``PREFIX``). The nearest ``RERANKED`` share of
each block of vectors is scored exactly. Queries are taken in blocks, each of them broadcast, against all vectors.

Inner products become angles by one more coordinate that fills every vector up to the largest norm; it is 0 in a
query. Equal vectors are one entry with the few smallest ids that an answer can need, so a vector that a third of all
rows share is posted and scored once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterlens.llm.steps import stored

PIVOTS = 512
PREFIX = 64
RERANKED = 0.15
LEAST_RERANKED = 256
BLOCK = 8192
QUERY_BLOCK = 4096


@dataclass
class Pivots:
    """Unit pivots in the space with the added coordinate, and the norm that it fills up to."""

    units: np.ndarray
    norm: float

    def order(self, vectors: np.ndarray, filled: bool) -> np.ndarray:
        """The nearest pivots of each vector, nearest first."""
        rest = np.zeros(len(vectors))
        if filled:
            rest = np.sqrt(np.maximum(0, self.norm**2 - (vectors**2).sum(axis=1)))
        nearness = np.column_stack([vectors, rest]) @ self.units.T
        length = min(PREFIX, len(self.units))
        some = np.argpartition(-nearness, length - 1, axis=1)[:, :length]
        inner = np.take_along_axis(nearness, some, axis=1)
        return np.take_along_axis(some, np.lexsort((some, -inner), axis=1), axis=1).astype(np.int16)


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def entries(rows: DataFrame, ids_kept: int) -> DataFrame:
    """(vector, ids): distinct vectors with their ``ids_kept`` smallest ids in order, from rows (id, vector)."""
    smallest = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= ids_kept)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _matrix(lists: pa.Array) -> np.ndarray:
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def choose_pivots(index: DataFrame) -> Pivots | None:
    """``PIVOTS`` distinct vectors in the order of a hash: a bounded sample, alike at every size."""
    norm = index.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    if norm is None:
        return None
    chosen = index.orderBy(F.xxhash64("vector"), "vector").limit(PIVOTS).select("vector").collect()
    vectors = np.array([row.vector for row in chosen], float)
    rest = np.sqrt(np.maximum(0, norm - (vectors**2).sum(axis=1)))
    units = np.column_stack([vectors, rest])
    return Pivots(units / np.linalg.norm(units, axis=1, keepdims=True), float(np.sqrt(norm)))


def _orderer(pivots, filled: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = pivots.value.order(_matrix(batch.column("vector")), filled)
                yield batch.append_column("pivots", pa.array(list(order), pa.list_(pa.int16())))

    return run


class InvertedFiles:
    """Postings of one block of vectors, ordered by pivot."""

    def __init__(self, orders: np.ndarray, n_pivots: int):
        rows, length = orders.shape
        by_pivot = np.argsort(orders, axis=None, kind="stable")
        self.rows = rows
        self.vector, self.rank = by_pivot // length, by_pivot % length
        self.begins = np.searchsorted(orders.ravel()[by_pivot], np.arange(n_pivots + 1))

    def nearest(self, order: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` vectors of least footrule distance to the order, ties in any way.

        The distance is a constant less twice (PREFIX - larger rank) for each pivot that both orders have.
        """
        if count >= self.rows:
            return np.arange(self.rows)
        length = len(order)
        spans = [slice(self.begins[p], self.begins[p + 1]) for p in order]
        vector = np.concatenate([self.vector[s] for s in spans])
        gain = np.concatenate([length - np.maximum(rank, self.rank[s]) for rank, s in enumerate(spans)])
        return np.argpartition(-np.bincount(vector, weights=gain, minlength=self.rows), count)[:count]


def _searcher(queries, nearest: int) -> Callable:
    """Arrow function: index rows to the ``nearest`` entries of the task for each query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, orders, n_pivots = queries.value
        best: list[list] = [[] for _ in vectors]
        for block in _blocks(batches):
            held, ids = _matrix(block.column("vector")), block.column("ids")
            files = InvertedFiles(_matrix(block.column("pivots")), n_pivots)
            count = max(LEAST_RERANKED, int(np.ceil(RERANKED * len(held))))
            for q, (query, order) in enumerate(zip(vectors, orders)):
                near = files.nearest(order, count)
                scores = held[near] @ query
                if len(near) > nearest:
                    # All entries that tie with the last are kept until their ids are compared.
                    last = np.partition(scores, len(scores) - nearest)[len(scores) - nearest]
                    near, scores = near[scores >= last], scores[scores >= last]
                found = [(-score, ids[int(i)].as_py()) for i, score in zip(near, scores)]
                best[q] = sorted(best[q] + found)[:nearest]
        rows = [(q, -score, listed) for q, found in enumerate(best) for score, listed in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([q for q, _, _ in rows], pa.int32()),
                pa.array([score for _, score, _ in rows], pa.float64()),
                pa.array([listed for _, _, listed in rows], pa.list_(pa.int64())),
            ],
            names=["query", "score", "ids"],
        )

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(begin, BLOCK))
            rows += held[-1].num_rows
            if rows >= BLOCK:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def nearest_vectors(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = 20
) -> DataFrame:
    """(query_id, rank, id, score): for every query row the ``nearest`` rows found, nearest first, ties to smaller id.

    Queries are the rows of ``vectors`` for which ``is_query`` holds; candidates are all rows but those of the query's
    own id. The score is the inner product in double precision. Rows with a null id or a vector that is null, zero or
    has a null or non-finite component take no part; neither do vectors of another length than the most common one
    (of equally common ones the shorter). Rows that repeat id and vector are one; an id with several vectors stands
    for each. An empty table, or one row, gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    length = lengths.length if lengths else 0
    rows = rows.where(F.size("vector") == length)
    index = stored(entries(rows.select("id", "vector"), nearest + 1), "vectors")
    pivots = choose_pivots(index)
    schema = "query_id long, rank int, id long, score double"
    if pivots is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(pivots)
    index = index.mapInArrow(_orderer(shared, True), "vector array<double>, ids array<long>, pivots array<short>")
    index = stored(index, "permutations")
    asked = rows.where("asked").select("id", "vector").distinct()
    asked = stored(asked.withColumn("hash", F.xxhash64("vector")), "asked")
    queries = stored(asked.select("hash", "vector").distinct(), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    answers = [
        stored(_answers(index, queries.where(F.pmod("hash", F.lit(blocks)) == block), pivots, nearest), "answers")
        for block in range(blocks)
    ]
    found = answers[0]
    for more in answers[1:]:
        found = found.union(more)
    joined = asked.join(found.withColumnRenamed("vector", "asked_vector"), (F.col("vector") == F.col("asked_vector")) & (F.col("hash") == F.col("asked_hash")))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, nearest)
    listed = joined.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "near"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), F.col("near.id").alias("id"), F.col("near.score").alias("score"))


def _answers(index: DataFrame, queries: DataFrame, pivots: Pivots, nearest: int) -> DataFrame:
    """(asked_hash, vector, near): the ``nearest`` + 1 best (score, id) of each query of a block, in order."""
    spark = index.sparkSession
    block = queries.collect()
    matrix = np.array([row.vector for row in block], float)
    orders = pivots.order(matrix, False) if len(block) else matrix
    shared = spark.sparkContext.broadcast((matrix, orders, len(pivots.units)))
    found = index.mapInArrow(_searcher(shared, nearest + 1), "query int, score double, ids array<long>")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    each = found.select("query", "score", F.explode("ids").alias("id")).withColumn("rank", F.row_number().over(best))
    each = each.where(F.col("rank") <= nearest + 1).groupBy("query")
    lists = each.agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    names = spark.createDataFrame(
        [(i, row.hash, row.vector) for i, row in enumerate(block)], "query int, asked_hash long, vector array<double>"
    )
    return lists.join(names, "query").select("asked_hash", "vector", "near")
