"""Recognition of date and date-time strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted formats.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_TIME_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?"
    r"(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$"
)


def _dashed(text: Column) -> Column:
    """Cheap test that keeps long prose away from the patterns."""
    return F.substring(text, 5, 1) == "-"


def _day_exists(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date").isNotNull()


def is_date(text: Column) -> Column:
    return _dashed(text) & text.rlike(DATE_PATTERN) & _day_exists(text)


def is_date_time(text: Column) -> Column:
    return _dashed(text) & text.rlike(DATE_TIME_PATTERN) & _day_exists(text)


def temporal_kind(text: Column) -> Column:
    """'date-time' for RFC 3339 text, 'date' for YYYY-MM-DD, else NULL."""
    return F.when(is_date_time(text), "date-time").when(is_date(text), "date")
