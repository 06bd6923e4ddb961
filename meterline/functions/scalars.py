"""Scalar expressions used by the operators (inventory rows J1-J10).

All are built-in column expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def event_time(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds to an instant."""
    return F.timestamp_millis(epoch_ms)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, cut toward zero."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, cut toward zero."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def or_default(value: Column | str, default: object) -> Column:
    """NULL becomes the default."""
    return F.coalesce(_col(value), F.lit(default))


def or_unknown(value: Column | str) -> Column:
    """A falsy name (NULL or empty) becomes ``Unknown``."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(UNKNOWN))


def processing_time() -> Column:
    """The wall clock; one value per batch or micro-batch."""
    return F.current_timestamp()


def ratio(dividend: Column | str, divisor: Column | str) -> Column:
    """A quotient that is NULL, not an error, when the divisor is zero."""
    return F.try_divide(_col(dividend), _col(divisor))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
