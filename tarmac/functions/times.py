"""Event time: milliseconds since the epoch, read and printed as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"


def event_time_ms(
    year: Column, month: Column, day: Column, hhmm: Column, strict: bool = True
) -> Column:
    """Scheduled departure as epoch milliseconds.

    `hhmm` is e.g. 1230; a blank reads as midnight, and 2400 is clipped to 23:00 of the same day.
    An impossible date fails the job, or gives NULL when not strict.
    """
    clock = F.coalesce(hhmm, F.lit(0)).cast("int")
    hour = F.least(F.greatest(F.floor(clock / 100), F.lit(0)), F.lit(23)).cast("int")
    minute = F.least(F.pmod(clock, F.lit(100)), F.lit(59)).cast("int")
    build = F.make_timestamp if strict else F.try_make_timestamp
    return F.unix_millis(
        build(
            years=year, months=month, days=day, hours=hour, mins=minute,
            secs=F.lit(0).cast("decimal(8,6)"), timezone=F.lit("UTC"),
        )
    )


def timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def bucket_start(ms: Column, step_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window that holds `ms`."""
    return ms - F.pmod(ms, F.lit(step_ms).cast("bigint"))


def stamp(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), STAMP)


def stamp_to_ms(text: Column) -> Column:
    return F.unix_millis(F.to_timestamp(text, STAMP))
