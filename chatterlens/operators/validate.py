"""Decode raw values, decide which messages are valid, keep the others with a reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.functions.text import is_blank
from chatterlens.functions.times import parse_time
from chatterlens.schemas import DEAD_LETTER, MESSAGE, MESSAGE_FIELDS, VALIDATED
from chatterlens.sources.tables import conform, unfold

MALFORMED = "malformed_json"
MISSING_TEXT = "missing_text"
MISSING_USER = "missing_user"
BAD_TIMESTAMP = "bad_timestamp"

# Fixed value: attributes the flow extracts, with their paths.
MESSAGE_PATHS = {name: f"$.{name}" for name in MESSAGE_FIELDS}

_BROKEN = "_broken"
_DECODED = T.StructType([*MESSAGE.fields, T.StructField(_BROKEN, T.StringType())])


def decode_messages(values: DataFrame) -> DataFrame:
    """Parse the ``value`` column once: ``raw`` text, the message fields and whether the value was ``malformed``.

    Anything but a JSON object is malformed. Other columns are kept.
    """
    others = [c for c in values.columns if c != "value"]
    raw = F.col("value").cast("string")
    parsed = F.from_json("raw", _DECODED, {"columnNameOfCorruptRecord": _BROKEN})
    # An empty value parses to null rather than to a broken record.
    broken = F.col(_BROKEN).isNotNull() | is_blank(F.col("raw"))
    return (
        values.select(*others, raw.alias("raw"))
        .select(*others, "raw", unfold(parsed))
        .withColumn("malformed", broken)
        .drop(_BROKEN)
    )


def extract_fields(values: DataFrame, paths: Mapping[str, str] = MESSAGE_PATHS) -> DataFrame:
    """Add one text column per JSON path to the raw values; a missing path gives null.

    Plain ``$.name`` paths are read in one parse, deeper ones in one parse each.
    """
    text = F.col("value").cast("string")
    keys = [path[2:] for path in paths.values()]
    if all(path.startswith("$.") and key.isidentifier() for path, key in zip(paths.values(), keys)):
        return values.select("*", F.json_tuple(text, *keys).alias(*paths))
    return values.select("*", *[F.get_json_object(text, path).alias(name) for name, path in paths.items()])


def with_reason(decoded: DataFrame) -> DataFrame:
    """Add the first reason for which a message is not valid; null for valid messages."""
    return decoded.withColumn(
        "reason",
        F.when(F.col("malformed"), MALFORMED)
        .when(is_blank(F.col("text")), MISSING_TEXT)
        .when(is_blank(F.col("user")), MISSING_USER),
    )


def valid_messages(judged: DataFrame, at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The valid branch, stamped with the validation flag and time (whole seconds). ``keep`` names further columns."""
    time = F.current_timestamp() if at is None else at
    stamped = (
        judged.filter(F.col("reason").isNull())
        .withColumn("event_time", parse_time(F.col("timestamp")))
        .withColumn("validated", F.lit(True))
        .withColumn("validation_time", F.date_trunc("second", time))
    )
    return conform(stamped, T.StructType([*[stamped.schema[name] for name in keep], *VALIDATED.fields]))


def dead_letters(judged: DataFrame, at: Column | None = None) -> DataFrame:
    """The other branch: the raw value with its reason."""
    time = F.current_timestamp() if at is None else at
    stamped = judged.filter(F.col("reason").isNotNull()).withColumn("validation_time", F.date_trunc("second", time))
    return conform(stamped, DEAD_LETTER)


def route(decoded: DataFrame, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Split decoded messages into (valid, dead letters); every row is in exactly one of them."""
    judged = with_reason(decoded)
    return valid_messages(judged, at), dead_letters(judged, at)


def validation_report(decoded: DataFrame) -> DataFrame:
    """Messages per problem. A message with several problems counts under each of them."""
    sound = ~F.col("malformed")
    problems = F.array_compact(
        F.array(
            F.when(~sound, F.lit(MALFORMED)),
            F.when(sound & is_blank(F.col("text")), F.lit(MISSING_TEXT)),
            F.when(sound & is_blank(F.col("user")), F.lit(MISSING_USER)),
            F.when(sound & parse_time(F.col("timestamp")).isNull(), F.lit(BAD_TIMESTAMP)),
        )
    )
    return decoded.select(F.explode(problems).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
