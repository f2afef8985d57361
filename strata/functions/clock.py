"""Time arithmetic that does not depend on the session time zone.

A ``TIMESTAMP`` is an instant; a ``TIMESTAMP_NTZ`` is a local (wall-clock)
time.  Spark's ``timestamp_diff`` and casts turn a local time into an instant
through the session time zone, so differences across a daylight-saving change
gain or lose an hour and local times inside a spring-forward gap move.  These
helpers count microseconds from the epoch directly: instants by
``unix_micros``, local times from their own date and clock fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def epoch_micros(c: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 00:00 of an instant (``TIMESTAMP``) or
    of a local time (``TIMESTAMP_NTZ``, wall clock); days for ``DATE``."""
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.date_part(F.lit("SECOND"), c)  # seconds with microseconds
        return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(MICROS_PER_DAY)
                + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
                + F.minute(c).cast("bigint") * F.lit(60_000_000)
                + (seconds * F.lit(1_000_000)).cast("bigint"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint") * F.lit(MICROS_PER_DAY)
    raise TypeError(f"not a time type: {dtype.simpleString()}")


def hours_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    """``end - start`` in hours; both of type ``dtype`` (wall clock for local
    times, elapsed time for instants)."""
    return (epoch_micros(end, dtype) - epoch_micros(start, dtype)) / F.lit(3.6e9)
