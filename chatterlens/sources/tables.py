"""Stored tables: labelled comments and scored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.schemas import LABELLED, RESULT

# Quotes inside a comment are doubled; a backslash is just a character.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_labelled_csv(
    spark: SparkSession, path: str, schema: T.StructType = LABELLED, multi_line: bool = True
) -> DataFrame:
    """Labelled comments from CSV with a header and a declared schema.

    ``multi_line`` lets quoted comments hold line breaks, at the price that one file is one task. Files of
    one-line comments read with ``multi_line=False`` are split.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)


def unfold(record: Column) -> Column:
    """The fields of a parsed record as columns, computed once per row.

    A plain selection of the fields would be copied, parsing included, into every filter that names one of them.
    """
    return F.inline(F.array(record))


def conform(df: DataFrame, schema: T.StructType = RESULT) -> DataFrame:
    """Select exactly the declared columns in their declared types.

    Missing columns become null, unknown ones are dropped, and a value that does not fit its type becomes null.
    """
    present = set(df.columns)
    columns = [
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns)


def write_results(df: DataFrame, path: str, mode: str = "overwrite", gather: bool = True) -> None:
    """Store results as Parquet in one folder per event date, so that time ranges prune folders.

    ``gather`` first brings the rows of a date together in files of even size, a large date in several; else every
    task writes a file for each date that it holds, which suits results that arrive in order of time.
    """
    dated = df.withColumn("event_date", F.to_date("event_time"))
    if gather:
        dated = dated.hint("rebalance", "event_date")
    dated.write.mode(mode).partitionBy("event_date").parquet(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType = RESULT) -> DataFrame:
    """Scan stored results without schema inference; ``event_date`` is the partition column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])).parquet(path)


def write_for_look_up(df: DataFrame, path: str, keys: Sequence[str] = ("id", "user"), time: str = "event_time", block: str = "16m") -> None:
    """Store rows so that one key or a short time finds its rows without reading the rest.

    Rows lie in order of time in files of their own ranges, so times skip files and parts of files by their bounds.
    Each part of ``block`` bytes has a Bloom filter of every key, so a look-up reads the parts that may hold it.
    """
    size = int(block[:-1]) << {"k": 10, "m": 20}[block[-1]]
    options = {"parquet.block.size": size, "parquet.bloom.filter.adaptive.enabled": "true"}
    options |= {f"parquet.bloom.filter.enabled#{key}": "true" for key in keys}
    conf, kind = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(kind)
    conf.set(kind, "TIMESTAMP_MICROS")  # the older form of times has no bounds
    try:
        ordered = df.repartitionByRange(time).sortWithinPartitions(time)
        ordered.write.mode("overwrite").options(**options).parquet(path)
    finally:
        conf.set(kind, before)


def look_up(spark: SparkSession, path: str, key: str, *found: object) -> DataFrame:
    """Rows of some values of a key, from a table of ``write_for_look_up``."""
    return spark.read.parquet(path).filter(F.col(key).isin(*found))
