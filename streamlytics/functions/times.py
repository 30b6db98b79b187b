"""Epoch conversions. The session zone is pinned to UTC, so no result depends on a host."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
MINUTE = "HH:mm"
DATETIME = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_millis(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def from_seconds(s: Column | str) -> Column:
    return F.timestamp_seconds(_col(s))


def day_of(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), DAY)


def minute_of(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), MINUTE)


def datetime_to_millis(text: Column | str) -> Column:
    return F.unix_millis(F.to_timestamp(_col(text), DATETIME))


def millis_to_datetime(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), DATETIME)


def plain(ts: Column | str) -> Column:
    """A zone-free timestamp, the type results leave the engine with."""
    return _col(ts).cast("timestamp_ntz")
