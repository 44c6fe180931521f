"""Arithmetic between naive-UTC timestamps and integer grid slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds of a naive timestamp since the start of year 1.

    The origin is a midnight and never after the data, so integer division floors.
    """
    return F.timestamp_diff("MICROSECOND", _ntz("0001-01-01 00:00:00"), ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, _ntz("0001-01-01 00:00:00"))


def floor_div(n: Column, width: int) -> Column:
    """Integer quotient of a number that is not negative."""
    return F.call_function("div", n, F.lit(width))


def slot_of(ts: Column, step_us: int) -> Column:
    """Number of the grid slot that holds ``ts``.

    Slots are anchored at a midnight; that is midnight of every day when the step divides
    a day.
    """
    return floor_div(micros(ts), step_us)


def slot_start(slot: Column, step_us: int) -> Column:
    return from_micros(slot * F.lit(step_us))


def to_naive_utc(instant: Column) -> Column:
    """TIMESTAMP to naive UTC, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _ntz("1970-01-01 00:00:00"))


def to_instant(naive_utc: Column) -> Column:
    """Naive UTC to TIMESTAMP (streams need it for watermarks)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _ntz("1970-01-01 00:00:00"), naive_utc))


def to_local_time(naive_utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), naive_utc)
