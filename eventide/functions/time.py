"""Event-time helpers: epoch conversion, interval parsing, formatting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "m": 60_000_000, "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}

# Format of rendered window bounds (fixed value): yyyy-MM-dd HH:mm:ss.
WINDOW_BOUND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def duration_us(spec) -> int:
    """'10 seconds' / '1 hour' / '15 min' / int microseconds -> microseconds."""
    if isinstance(spec, (int, float)):
        return int(spec)
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", str(spec))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad duration: {spec!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def duration_spark(spec) -> str:
    """Duration in the '<n> microseconds' form Spark interval strings accept."""
    return f"{duration_us(spec)} microseconds"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column.

    NTZ values are read as UTC wall-clock (the session is pinned to UTC).
    """
    return F.unix_micros(col_of(ts).cast("timestamp"))


def from_epoch_us(us) -> Column:
    return F.timestamp_micros(col_of(us))


def to_event_time(c, unit: str = "s") -> Column:
    """Epoch number in ``unit`` ('s' or 'ms') -> TIMESTAMP (rowtime attribute)."""
    c = col_of(c)
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    raise ValueError(unit)


def format_bound(us) -> Column:
    """Epoch microseconds -> 'yyyy-MM-dd HH:mm:ss' text in UTC."""
    return F.date_format(F.timestamp_micros(col_of(us)).cast("timestamp_ntz"), WINDOW_BOUND_FORMAT)


def slot_of(us: Column, size_us: int) -> Column:
    """Number of the slot of ``size_us`` microseconds that holds ``us``, in integers only (exact for any timestamp)."""
    return F.call_function("div", us - F.pmod(us, F.lit(size_us)), F.lit(size_us)).cast("long")


def utc_day(ts) -> Column:
    """UTC calendar day number (days since epoch) of an event time."""
    return slot_of(epoch_us(ts), 86_400_000_000)
