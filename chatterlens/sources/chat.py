"""Raw chat protocol lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterlens.functions.text import after_first, before_first, remove_mark, strip, truncate
from chatterlens.functions.times import utc_iso

# Fixed values of the chat protocol and of the message built from it.
KEEP_ALIVE = "PING"
MESSAGE_MARK = "PRIVMSG"
CHAT_LOCATION = "Twitch"
USER_SIZE = 50


def chat_messages_only(lines: DataFrame, column: str = "value") -> DataFrame:
    """Keep chat messages; keep-alive and all other protocol lines go."""
    line = F.col(column)
    return lines.filter(~F.startswith(line, F.lit(KEEP_ALIVE)) & F.contains(line, F.lit(MESSAGE_MARK)))


def chat_lines_to_messages(
    lines: DataFrame, column: str = "value", at: Column | None = None, location: str = CHAT_LOCATION
) -> DataFrame:
    """Parse ``:nick!nick@host PRIVMSG #channel :text`` lines into messages received ``at`` (default: now).

    Lines without a text part and lines whose text is blank give no message.
    """
    line = F.col(column)
    prefix = before_first(line, MESSAGE_MARK)
    message = after_first(line, MESSAGE_MARK)
    user = strip(remove_mark(before_first(prefix, "!"), ":"))
    received = F.current_timestamp() if at is None else at
    return (
        chat_messages_only(lines, column)
        .select(
            strip(after_first(message, ":")).alias("text"),
            truncate(user, USER_SIZE).alias("user"),
            utc_iso(received).alias("timestamp"),
            F.lit(location).alias("location"),
        )
        .filter(F.length("text") >= 1)
    )
