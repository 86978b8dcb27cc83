"""Date windows and time normalisation."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}$")


def _day(text: str) -> dt.date:
    if not _DAY.match(text):
        raise ValueError(f"{text!r} is not a YYYY-MM-DD date")
    return dt.date.fromisoformat(text)


def date_window(
    preset: str, a: str | None = None, b: str | int | None = None, today: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """Half-open ``[start, end)`` days of a preset.

    ``today``; ``last30`` (30 days up to and including today); ``day`` a; ``between`` a and b, both
    included; ``days`` b days from a.
    """
    one = dt.timedelta(days=1)
    if preset == "today":
        today = today or dt.date.today()
        return today, today + one
    if preset == "last30":
        today = today or dt.date.today()
        return today + one - dt.timedelta(days=30), today + one
    if preset == "day":
        return _day(a), _day(a) + one
    if preset == "between":
        return _day(a), _day(b) + one
    if preset == "days":
        if not re.match(r"\d+$", str(b)):
            raise ValueError(f"{b!r} is not a number of days")
        return _day(a), _day(a) + dt.timedelta(days=int(b))
    raise ValueError(f"unknown preset {preset!r}")


def in_window(ts: Column, window: tuple[dt.date, dt.date]) -> Column:
    """Range predicate on a timestamp column; reaches the Parquet scan as a pushed filter."""
    start, end = (F.lit(dt.datetime.combine(d, dt.time())).cast("timestamp_ntz") for d in window)
    return (ts >= start) & (ts < end)


def days_between(start: Column, end: Column) -> Column:
    """Days of the half-open range as an array; empty when ``start >= end``."""
    return F.when(start < end, F.sequence(start, F.date_sub(end, 1))).otherwise(
        F.array().cast("array<date>")
    )


def minutes_to_time(text: Column) -> Column:
    """``Y-m-d H:M`` to ``Y-m-d H:M:00``."""
    return F.concat(text, F.lit(":00"))


def epoch_to_time(text: Column) -> Column:
    """Formatted time of the epoch seconds in the last ten characters."""
    return F.from_unixtime(F.right(text, F.lit(10)).try_cast("bigint"), TIME_FORMAT)


def time_to_epoch(text: Column) -> Column:
    """Epoch seconds of a formatted time; null when it does not parse."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(TIME_FORMAT)))
