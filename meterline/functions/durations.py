"""Durations written as ``"<number> <unit>"``, the form Spark's window functions take."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def to_micros(duration: str) -> int:
    """``"5 minutes"`` -> 300000000. Months and years have no fixed length and are refused."""
    number, _, unit = duration.strip().partition(" ")
    try:
        return int(number) * _UNIT_MICROS[unit.strip().lower().removesuffix("s")]
    except (KeyError, ValueError):
        raise ValueError(f"not a fixed duration: {duration!r}") from None


def interval(duration: str) -> Column:
    """The duration as a day-time interval column."""
    return F.expr(f"INTERVAL '{to_micros(duration) / 1_000_000:.6f}' SECOND")


def bucket_start(time: str, duration: str) -> Column:
    """The start, in microseconds, of the epoch-aligned bucket a time lies in."""
    micros = F.unix_micros(time)
    return micros - F.pmod(micros, F.lit(to_micros(duration)))
