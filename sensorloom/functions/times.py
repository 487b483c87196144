"""Timestamps: parsing, rendering, and cutting time into pieces."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats on the wire.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LOCAL_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
TIME_OF_DAY = "HH:mm:ss"

_UNIT_SECONDS = {
    "millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800,
}


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def micros(duration: str | int | float) -> int:
    """Length in microseconds of '15 minutes', '120 seconds', or of a number of seconds."""
    if isinstance(duration, (int, float)):
        return int(round(duration * 1_000_000))
    match = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match.group(2) not in _UNIT_SECONDS:
        raise ValueError(f"not a fixed duration: {duration!r}")
    return int(round(float(match.group(1)) * _UNIT_SECONDS[match.group(2)] * 1_000_000))


def parse_iso(column, fallback=None) -> Column:
    """ISO-8601 text (with Z, an offset, or neither = UTC) to TIMESTAMP, null if unreadable.

    Zone-aware, so the result does not depend on a quoted 'Z' in a pattern. `fallback` (for
    example the broker's record time) replaces unreadable values.
    """
    parsed = F.try_to_timestamp(_c(column))
    return parsed if fallback is None else F.coalesce(parsed, _c(fallback))


def format_iso(column) -> Column:
    """TIMESTAMP to millisecond ISO text with Z; needs a UTC session."""
    return F.date_format(_c(column), ISO_MILLIS)


def event_date(column) -> Column:
    return F.date_format(_c(column), "yyyy-MM-dd")


def epoch_floor(column, width: str) -> Column:
    """Start of the epoch-aligned interval of length `width` that holds the timestamp."""
    w = micros(width)
    us = F.unix_micros(_c(column))
    return F.timestamp_micros(us - F.pmod(us, F.lit(w)))


def slice_number(column, width_us: int) -> Column:
    """Number of the epoch-aligned slice of `width_us` microseconds that holds the timestamp."""
    us = F.unix_micros(_c(column))
    return ((us - F.pmod(us, F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def render_in_zone(column, zone: str = "Asia/Kolkata", suffix: str = "+05:30") -> Column:
    """Instant as local ISO text with a fixed offset suffix; text that is no time stays as is."""
    text = _c(column)
    ts = F.try_to_timestamp(text.cast("string"))
    local = F.date_format(F.from_utc_timestamp(ts, zone), LOCAL_SECONDS)
    return F.when(text.isNull(), F.lit("")).otherwise(
        F.coalesce(F.concat(local, F.lit(f".000{suffix}")), text.cast("string"))
    )
