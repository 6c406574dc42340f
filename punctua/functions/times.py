"""Parsing of times, calendar fields and clock arithmetic.

ANSI mode makes the plain parsers raise on bad text, so the ``try_`` forms are
used all through: bad text gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text patterns of the actual-data feed.
DAY_PATTERN = "dd.MM.yyyy"
MINUTE_PATTERN = "dd.MM.yyyy HH:mm"
SECOND_PATTERN = "dd.MM.yyyy HH:mm:ss"

# Service hours of the journey planner, in seconds after midnight.
SERVICE_START = 5 * 3600
SERVICE_END = 23 * 3600


def safe_ts(col: Column | str, pattern: str) -> Column:
    return F.try_to_timestamp(_c(col), F.lit(pattern))


def safe_date(col: Column | str, pattern: str = DAY_PATTERN) -> Column:
    return safe_ts(col, pattern).cast("date")


def safe_cast(col: Column | str, to: str) -> Column:
    return _c(col).try_cast(to)


def epoch(col: Column | str) -> Column:
    """Seconds since 1970 of a timestamp with or without zone."""
    return F.unix_timestamp(_c(col))


def local_time(epoch_s: Column | str, zone: str) -> Column:
    """Wall-clock time in ``zone`` of epoch seconds."""
    return F.from_utc_timestamp(F.timestamp_seconds(_c(epoch_s)), zone)


def clock_seconds(col: Column | str) -> Column:
    """Seconds after midnight of ``HH:mm:ss`` text; hours may exceed 24."""
    part = F.split(_c(col), ":")
    piece = [F.get(part, F.lit(i)).try_cast("int") for i in range(3)]
    return piece[0] * 3600 + piece[1] * 60 + piece[2]


def in_clock_window(col: Column | str, lo: str, hi: str) -> Column:
    """Zero-padded ``HH:mm:ss`` text between two bounds, both included.

    The text order equals the time order, so the comparison is left on the raw
    column, where the scan can use it; hours above 24 fail for any ``hi``
    below ``24:00:00``.
    """
    return _c(col).between(lo, hi)


def calendar_features(ts: Column | str) -> dict[str, Column]:
    """Calendar fields of a timestamp; the weekday counts from 0 = Monday."""
    t = _c(ts)
    return {
        "minute": F.minute(t),
        "hour": F.hour(t),
        "month": F.month(t),
        "year": F.year(t),
        "week_of_year": F.weekofyear(t),
        "day_of_year": F.dayofyear(t),
        "day_of_week": F.weekday(t),
    }


def iso_year(ts: Column | str) -> Column:
    """Year the ISO week of ``ts`` belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), _c(ts))


def day_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "EEEE")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes as a double."""
    return (epoch(end) - epoch(start)) / F.lit(60.0)


def minute_slots(lo: int = SERVICE_START // 60, hi: int = SERVICE_END // 60) -> Column:
    """Array of all minutes from ``lo`` to ``hi``, both included."""
    return F.sequence(F.lit(lo), F.lit(hi))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
