"""Newest or first rows per key, and the keyed upsert view built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from chatterlens.functions.text import content_key

# Up to this rank Spark itself cuts each key down to n rows before the shuffle.
_RANK_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _content(df: DataFrame) -> Column:
    """A number for the whole row, to decide between rows that are otherwise equal in the same way everywhere."""
    return F.xxhash64(*[F.col(name) for name, kind in df.dtypes if "map<" not in kind])


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    A frequent key is cut before it is shuffled: by Spark's group limit for small ``n``, by a first round over as
    many parts of each key as there are shuffle partitions for large ``n``. The order has to be total for a
    repeatable answer.
    """
    rank, conf = "_rank", df.sparkSession.conf
    if n > int(conf.get(_RANK_LIMIT)):
        salt = "_salt"
        salts = int(conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn(salt, F.pmod(_content(df), F.lit(salts)))
        rounds = salted.withColumn(rank, F.row_number().over(Window.partitionBy(*keys, salt).orderBy(*order)))
        df = rounds.filter(F.col(rank) <= n).drop(rank, salt)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n).drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, tie: str, n: int = 1) -> DataFrame:
    """The newest ``n`` rows of every key; equal times are decided by the larger ``tie``."""
    return best_per_key(df, keys, [F.desc(time), F.desc(tie)], n)


def drop_repeats(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row per event id: the first seen."""
    return best_per_key(df, [key], [F.asc(time), _content(df)])


def with_document_id(df: DataFrame, columns: Sequence[str] = ("user", "timestamp", "text")) -> DataFrame:
    """Document id from the message content. Times alone are no id: many messages share a second."""
    return df.withColumn("id", content_key(*columns))


def upsert_view(
    log: DataFrame, key: Sequence[str] = ("id",), order: Sequence[str] = ("run", "batch_id", "arrival")
) -> DataFrame:
    """Current documents of an append-only log: a later write replaces an earlier one with the same key.

    Later is a later run, batch and place in the topic, as far as the log has these columns; what is equal in all of
    them is decided by content.
    Where the key contains the time, as the content id does, a log filtered by event date gives the documents of
    those dates without reading the others.
    """
    known = [F.desc(column) for column in order if column in log.columns]
    return best_per_key(log, key, [*known, _content(log)])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All batches written by the batch-folder sink, with the run and batch they came from."""
    return spark.read.parquet(path).withColumns({"run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long")})


def rows_per_batch(log: DataFrame) -> DataFrame:
    """How many rows each batch wrote."""
    return log.groupBy("run", "batch_id").agg(F.count("*").alias("n"))


def compact_log(spark: SparkSession, path: str, target: str, key: Sequence[str] = ("id",)) -> None:
    """Rewrite a log as one batch folder of its current documents, in another place.

    The folder bears the log's last run and batch, and keeps the folders of event dates.
    """
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("a log cannot be compacted in place")
    log = read_log(spark, path)
    run, batch_id = log.agg(F.max(F.struct("run", "batch_id"))).first()[0]
    dates = [name for name in ("event_date",) if name in log.columns]
    current = upsert_view(log, key).drop("run", "batch_id")
    current = current.hint("rebalance", *dates) if dates else current
    current.write.mode("overwrite").partitionBy(*dates).parquet(f"{target}/run={run}/batch_id={batch_id}")
