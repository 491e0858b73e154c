"""Time helpers over UTC TIMESTAMP_NTZ columns."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_hour(column: str | Column) -> Column:
    """Start of the hour. `date_trunc` returns TIMESTAMP, so cast back."""
    return F.date_trunc("hour", column).cast("timestamp_ntz")


def utc_now() -> Column:
    """The time of the query, or of the micro-batch on a stream."""
    return F.current_timestamp().cast("timestamp_ntz")


def hours_ago(hours: int, now: datetime | Column | None = None) -> Column:
    """`now` less some hours. Pass `now` to get repeatable results."""
    if now is None:
        now = utc_now()
    elif isinstance(now, datetime):
        now = F.lit(now).cast("timestamp_ntz")
    return now - F.make_interval(hours=F.lit(hours))


def lookback_day(now: datetime, hours: int) -> datetime:
    """Start of the day a look-back begins in: the cutoff for rewriting whole day partitions."""
    return (now - timedelta(hours=hours)).replace(hour=0, minute=0, second=0, microsecond=0)
