"""Timestamps: ISO-8601 text to instants and back, independent of the session time zone.

Instants are `timestamp`; stored wall-clock columns are `timestamp_ntz` in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; NULL where it cannot be read.

    Any number of fraction digits and any offset is accepted. Text without an
    offset is read in the session time zone.
    """
    return F.try_to_timestamp(text)


def utc_wall_clock(instant: Column) -> Column:
    """Instant to the UTC wall clock as `timestamp_ntz`."""
    seconds = (F.unix_micros(instant) / F.lit(1000000).cast("decimal(20,0)")).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)


def utc_instant(wall_clock: Column) -> Column:
    """UTC wall clock (`timestamp_ntz`) to an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), wall_clock))


def format_iso(wall_clock: Column) -> Column:
    """UTC wall clock to ISO-8601 with milliseconds and `Z`."""
    return F.date_format(wall_clock.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from `start` to `end`, rounded towards zero."""
    return F.timestamp_diff("SECOND", start, end)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)
