"""Column functions over timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """Text to timestamp, null when it is not one. Zone-less text is read in the session zone (UTC)."""
    return text.try_cast("timestamp")


def stamp(at: Column) -> Column:
    """``2024-01-31 08:15:00``"""
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def utc_iso(at: Column) -> Column:
    """``2024-01-31T08:15:00.123456Z``"""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
