"""Nested comment items of a video listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.schemas import COMMENT_ITEM
from chatterlens.sources.tables import unfold

# Fixed value: location of a comment whose author has no channel id.
UNKNOWN_LOCATION = "Unknown"


def comments_to_messages(items: DataFrame, column: str = "item") -> DataFrame:
    """Flatten comment items to ``id`` plus the canonical message.

    ``column`` holds the item as struct or as JSON text. Items without text, author or time cannot become a
    message and are left out.
    """
    item = F.col(column)
    if isinstance(items.schema[column].dataType, T.StringType):
        item = F.from_json(item, COMMENT_ITEM)
    comment = F.col("snippet.topLevelComment.snippet")
    return (
        items.select(unfold(item))
        .select(
            "id",
            comment["textDisplay"].alias("text"),
            comment["authorDisplayName"].alias("user"),
            comment["publishedAt"].alias("timestamp"),
            F.coalesce(comment["authorChannelId"]["value"], F.lit(UNKNOWN_LOCATION)).alias("location"),
        )
        .filter("text is not null and user is not null and timestamp is not null")
    )
