"""Steps that several operators share: results written to the shared folder, and connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterlens.session import shared_folder

_temporary: list[list[str]] = []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: short lineage, and lost executors lose nothing."""
    folder = shared_folder(df.sparkSession, purpose)
    if _temporary:
        _temporary[-1].append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete what is stored inside, and let Spark drop the shuffle files of what was computed from it.

    What comes out has to be stored by ``lasting`` before.
    """
    _temporary.append([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for folder in _temporary.pop():
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        release(spark)


def lasting(df: DataFrame, purpose: str) -> DataFrame:
    """Store a result that outlives the innermost ``temporary``."""
    inner = _temporary.pop()
    try:
        return stored(df, purpose)
    finally:
        _temporary.append(inner)


def release(spark: SparkSession) -> None:
    """Have shuffle files of finished jobs deleted; Spark does so once the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def connected_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component's name is its smallest node.

    ``known`` is an earlier result for other links, which count too: it takes the place of those links.

    Alternating large-star and small-star rounds until only stars are left, which a further round would not change;
    each is an aggregation and a join by node, so the number of rounds grows with the logarithm of the largest
    component. Rounds are written to the shared folder. No links give an empty result; repeated links and loops change
    nothing.
    """
    if known is not None:
        links = links.select("a", "b").union(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = stored(edges, "links")
    while not _only_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has larger neighbours only, or a single one, which is smaller. Edges go from larger to
    smaller and do not repeat."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    counts = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return not counts.agg(F.max(F.expr("smaller > 1 OR smaller = 1 AND larger = 1"))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = both.join(least, F.col("a") == F.col("node")).where("b > a")
    return joined.select(F.col("b").alias("a"), F.least("least", "a").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = edges.join(least, F.col("a") == F.col("node"))
    others = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024, few: int = 10_000) -> float:
    """The k-th largest value of a double column without nulls or NaN, exactly and without sorting.

    Each round counts ``bins`` equal bins of the range that holds the value; a range of at most ``few`` rows is
    fetched. Infinity if k is 0, minus infinity if there are at most k rows.
    """
    if k <= 0:
        return float("inf")
    rows, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if rows <= k:
        return float("-inf")
    inside, above = df, 0
    while low < high:
        if rows <= few:
            values = sorted((row[0] for row in inside.select(column).collect()), reverse=True)
            return values[k - above - 1]
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("bin")
        counts = inside.groupBy(at).agg(F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))
        for found in sorted(counts.collect(), key=lambda row: -row.bin):
            if above + found.rows >= k:
                break
            above += found.rows
        rows, low, high = found.rows, found.low, found.high
        inside = df.where(F.col(column).between(low, high))
    return low
