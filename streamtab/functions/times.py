"""Durations and instants as integer microseconds, so that bounds are exact."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_PART = re.compile(r"(\d+)\s+([a-z]+?)s?(?=\s|$)")


def micros(duration: str) -> int:
    """`'1 hour 5 minutes'` -> 3_900_000_000; a leading minus negates the whole."""
    text = duration.strip().lower()
    if text.startswith("-"):
        return -micros(text[1:])
    parts = _PART.findall(text)
    if not parts or _PART.sub("", text).strip() or any(unit not in _UNIT for _, unit in parts):
        raise ValueError(f"not a fixed duration: {duration!r}")
    return sum(int(n) * _UNIT[unit] for n, unit in parts)


def epoch_us(col: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def from_us(col: Column) -> Column:
    return F.timestamp_micros(col)


def as_ntz(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
