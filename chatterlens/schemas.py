"""Record layouts shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


MESSAGE = _fields(
    text=T.StringType(),
    user=T.StringType(),
    timestamp=T.StringType(),
    location=T.StringType(),
)

VALIDATED = _fields(
    text=T.StringType(),
    user=T.StringType(),
    timestamp=T.StringType(),
    location=T.StringType(),
    event_time=T.TimestampType(),
    validated=T.BooleanType(),
    validation_time=T.TimestampType(),
)

DEAD_LETTER = _fields(
    raw=T.StringType(),
    reason=T.StringType(),
    validation_time=T.TimestampType(),
)

RESULT = _fields(
    text=T.StringType(),
    user=T.StringType(),
    timestamp=T.StringType(),
    event_time=T.TimestampType(),
    source=T.StringType(),
    sentiment=T.StringType(),
    confidence=T.DoubleType(),
    predicted_at=T.TimestampType(),
)

METRIC = _fields(
    model=T.StringType(),
    accuracy=T.DoubleType(),
    f1_score=T.DoubleType(),
    precision=T.DoubleType(),
    recall=T.DoubleType(),
    training_time=T.DoubleType(),
    fit_time=T.DoubleType(),
    error=T.StringType(),
)

LABELLED = _fields(Comment=T.StringType(), Sentiment=T.StringType())

# One item of a comment listing: the comment sits three levels down and the channel id may be absent.
COMMENT_ITEM = _fields(
    id=T.StringType(),
    snippet=_fields(
        topLevelComment=_fields(
            snippet=_fields(
                textDisplay=T.StringType(),
                authorDisplayName=T.StringType(),
                publishedAt=T.StringType(),
                authorChannelId=_fields(value=T.StringType()),
            )
        )
    ),
)

MESSAGE_FIELDS = MESSAGE.fieldNames()
