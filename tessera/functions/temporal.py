"""Dates, times, timestamps and intervals from what other columns have, to the microsecond."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exact import interval

#: Microseconds of a unit of time, or days of a unit of days.
_MICROS = {"micros": 1, "millis": 1000, "secs": 1_000_000, "mins": 60_000_000, "hours": 3_600_000_000}
_DAYS = {"days": 1, "weeks": 7}


def as_date(x: Column) -> Column:
    """The date of a text, timestamp or date; a text that is no date is an error."""
    return F.to_date(x)


def as_timestamp(x: Column) -> Column:
    """The timestamp, without a zone, of a text, date or timestamp."""
    return F.to_timestamp_ntz(x) if x is not None else x


def as_time(x: Column) -> Column:
    """The time of day of a text HH:MM, HH:MM:SS or HH:MM:SS.f; other texts are an error."""
    return F.to_time(F.when(x.rlike(r"^\d{1,2}:\d{2}$"), F.concat(x, F.lit(":00"))).otherwise(x))


def time_micros(x: Column) -> Column:
    """Microseconds since midnight."""
    return (F.hour(x).cast("long") * 3600 + F.minute(x) * 60) * 1_000_000 + (F.call_function("second", x) * 1_000_000).cast("long")


def as_interval(x: Column, unit: str) -> Column:
    """An interval of x units: secs, mins, hours, millis or micros (rounded to microseconds), or whole days or weeks."""
    zero = F.lit(0)
    if unit in _DAYS:
        return interval(zero, (x * _DAYS[unit]).cast("int"), zero)
    if unit not in _MICROS:
        raise ValueError(f"unknown unit {unit!r}; one of {', '.join([*_MICROS, *_DAYS])}")
    return interval(zero, zero, F.round(x * _MICROS[unit]).cast("long"))


def interval_between(begin: Column, end: Column) -> Column:
    """end - begin of two timestamps, in microseconds alone."""
    return interval(F.lit(0), F.lit(0), F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp")))
