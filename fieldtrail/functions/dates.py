"""Text dates: parsing, truncating and splitting ranges (O-P12, O-P13, O-P17, O-F4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a text must start with to count as a date.
DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
_CALENDAR_START = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def to_timestamp(text: Column) -> Column:
    """O-P12: ISO text to a timestamp, NULL on failure; a year or month alone is no date."""
    return F.when(text.rlike(_CALENDAR_START), text.try_cast("timestamp"))


def to_date(text: Column) -> Column:
    """O-P13: the offset is applied before the time of day is cut off."""
    return to_timestamp(text).cast("date")


def range_start(text: Column) -> Column:
    """O-P17: everything before the first ``/``."""
    return F.get(F.split(text, "/", 2), F.lit(0))


def range_end(text: Column) -> Column:
    """O-P17: everything after the first ``/``, NULL when there is none."""
    return F.get(F.split(text, "/", 2), F.lit(1))


def looks_like_date(text: Column) -> Column:
    """O-F4."""
    return text.rlike(DATE_PREFIX)
