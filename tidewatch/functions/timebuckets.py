"""Time expressions. The session time zone is UTC, so every bucket is a UTC bucket."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date, `T`, a time with optional fraction, and `Z` or a numeric offset.
RFC3339_SHAPE = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{1,2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)


def parse_rfc3339(text: Column) -> Column:
    """The instant of an RFC 3339 text, or NULL when it is not one.

    The shape check keeps out date-only and zone-less texts the cast would
    take; the cast rejects impossible dates and times.
    """
    dotted = F.when(text.contains(","), F.translate(text, ",", ".")).otherwise(text)
    return F.when(text.rlike(RFC3339_SHAPE), F.try_to_timestamp(dotted))


def format_rfc3339(instant: Column) -> Column:
    """An instant as RFC 3339 text in UTC, whole seconds."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def hour_bucket(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def second_bucket(instant: Column) -> Column:
    return F.date_trunc("second", instant)


def instant(value: datetime | Column) -> Column:
    """A literal for a datetime (naive means UTC); a column passes through."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def cutoff(as_of: datetime | Column, hours: int) -> Column:
    """The start of the window that ends at `as_of`; not truncated to the hour."""
    if isinstance(as_of, Column):
        return as_of - F.make_dt_interval(hours=F.lit(hours))
    return instant(as_of) - F.lit(timedelta(hours=hours))
