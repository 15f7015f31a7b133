"""Most frequent values over any range of days, from summaries of the days.

A summary keeps the most frequent values of a day with their exact counts, and the count of the first one that it
leaves out: no value that a day's summary does not name is more frequent than that. Summaries of several days merge by
sums, so every value has a least and a greatest possible count. Where the bounds prove which values can be among the
most frequent, only these are counted again; where they cannot, all are counted.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatterlens.operators.dashboards import top_values

SIZE = 1000  # values of a day's summary


def day_summaries(df: DataFrame, column: str, time: str = "event_time", size: int = SIZE) -> DataFrame:
    """(day, value, n, rest) of the ``size`` most frequent values of each day; ``rest`` is the count of the next one.

    Rows without a value or time are not counted.
    """
    dated = df.select(F.to_date(time).alias("day"), F.col(column).alias("value")).filter("day is not null and value is not null")
    counts = dated.groupBy("day", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("day").orderBy(F.desc("n"), "value"))
    ranked = counts.withColumn("place", place).filter(F.col("place") <= size + 1)
    next_one = F.max(F.when(F.col("place") > size, F.col("n"))).over(Window.partitionBy("day"))
    held = ranked.withColumn("rest", F.coalesce(next_one, F.lit(0).cast("long"))).filter(F.col("place") <= size)
    return held.select("day", "value", "n", "rest")


def write_summaries(df: DataFrame, path: str, column: str, time: str = "event_time", size: int = SIZE) -> None:
    """Store the summaries of the days that ``df`` holds in full; days that are there already are replaced."""
    found = day_summaries(df, column, time, size).hint("rebalance", "day")
    writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def possible(summaries: DataFrame, first: date, last: date, n: int) -> DataFrame | None:
    """Values that can be among the ``n`` most frequent from ``first`` to ``last``; None where all can.

    The driver sees the ``n`` largest least counts and one sum.
    """
    days = summaries.filter(F.col("day").between(F.lit(first), F.lit(last)))
    unnamed = days.groupBy("day").agg(F.max("rest").alias("rest")).agg(F.sum("rest")).first()[0] or 0
    held = days.groupBy("value").agg(F.sum("n").alias("least"), F.sum("rest").alias("named"))
    best = [row.least for row in held.orderBy(F.desc("least")).limit(n).collect()]
    if unnamed and (len(best) < n or unnamed >= best[-1]):
        return None
    return held.filter(F.col("least") + unnamed - F.col("named") >= (best[-1] if len(best) == n else 0)).select("value")


def top_between(
    summaries: DataFrame, rows: DataFrame, column: str, first: date, last: date, n: int = 10, time: str = "event_time"
) -> DataFrame:
    """(column, n) of the ``n`` most frequent values from ``first`` to ``last``, exactly; ties are ordered by value.

    ``rows`` are those that were summarised; of stored results only the folders of the days are read.
    """
    inside = rows.filter(F.to_date(time).between(F.lit(first), F.lit(last)))
    if "event_date" in rows.columns:
        inside = inside.filter(F.col("event_date").between(F.lit(first), F.lit(last)))
    candidates = possible(summaries, first, last, n)
    if candidates is not None:
        named = candidates.withColumnRenamed("value", "_value")
        inside = inside.join(named, F.col(column) == F.col("_value"), "left_semi")
    return top_values(inside, column, n)
