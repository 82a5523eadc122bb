"""Epoch conversion and calendar parts. Callers run with a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAY_ENCODINGS = ("name", "zero", "one")


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return F.timestamp_millis(ms.cast("long"))


def from_epoch_ms_as_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds (integer division)."""
    return F.timestamp_seconds(F.call_function("div", ms.cast("long"), F.lit(1000).cast("long")))


def weekday(ts: Column, encoding: str) -> Column:
    """Weekday as its English name, as 0 = Sunday, or as 1 = Sunday."""
    if encoding == "name":
        return F.date_format(ts, "EEEE")
    if encoding == "zero":
        return F.dayofweek(ts) - 1
    if encoding == "one":
        return F.dayofweek(ts)
    raise ValueError(f"weekday encoding must be one of {WEEKDAY_ENCODINGS}, got {encoding!r}")


def calendar_parts(ts: Column, weekday_encoding: str) -> dict[str, Column]:
    """Hour, day, ISO week, month, year and weekday of a timestamp."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday(ts, weekday_encoding),
    }


def text_to_timestamp(text: Column) -> Column:
    """Date or timestamp text to a timestamp; unreadable text becomes null."""
    return F.try_to_timestamp(text)
