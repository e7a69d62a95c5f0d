"""Timestamps, time buckets and clamping. None depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.schema import METRIC_MAX_AGE_DAYS

MICROS = 1_000_000
# Timestamps hold 64-bit microseconds.
MAX_SECONDS = (2**63 - 1) // MICROS


def epoch_to_timestamp(text: Column) -> Column:
    """Epoch-seconds text to a timestamp, fractions cut off; other text gives NULL.

    The way over decimal takes "12.7" without taking "NaN" or "1d". A number
    too large for a timestamp gives NULL too, where the conversion would raise.
    """
    seconds = text.try_cast("decimal(38,6)").try_cast("bigint")
    return F.timestamp_seconds(F.when(seconds.between(-MAX_SECONDS, MAX_SECONDS), seconds))


def is_plausible(time: Column, first: Column, last: Column) -> Column:
    """False for a time that is there but outside of what the source can have seen."""
    return time.isNull() | time.between(first, last)


def bucket_start(time: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``time``; NULL for NULL.

    The same instant as ``F.window(..).start``, but ``F.window`` drops rows
    without a time, and the interval join has to keep them.
    """
    micros = F.unix_micros(time)
    return F.timestamp_micros(F.try_subtract(micros, F.pmod(micros, F.lit(seconds * MICROS))))


def shift_seconds(time: Column, seconds: int) -> Column:
    """The time moved; NULL where no timestamp can hold the result."""
    return F.timestamp_micros(F.try_add(F.unix_micros(time), F.lit(seconds * MICROS).cast("bigint")))


def on_bucket_edge(time: Column, seconds: int) -> Column:
    """True if ``time`` is exactly the start of its bucket."""
    return F.unix_micros(time) % F.lit(seconds * MICROS) == F.lit(0)


def utc_wall_clock(time: Column) -> Column:
    """Timestamp to the zone-less UTC wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(time), epoch)


def wall_clock_epoch(wall_clock: Column) -> Column:
    """Whole epoch seconds of a zone-less wall clock that is read as UTC.

    Taken from its parts: differences of timestamps go by the session zone.
    """
    days = F.unix_date(F.to_date(wall_clock)).cast("bigint")
    hours = days * 24 + F.hour(wall_clock)
    return (hours * 60 + F.minute(wall_clock)) * 60 + F.second(wall_clock)


def clamp_timestamp(time: Column, now: Column, max_age_days: int = METRIC_MAX_AGE_DAYS) -> Column:
    """Move a timestamp into the range a metric store accepts.

    Too old becomes one second inside the oldest allowed moment; a future or
    missing timestamp becomes ``now``.
    """
    oldest = shift_seconds(now, -max_age_days * 24 * 3600)
    return (
        F.when(time < oldest, shift_seconds(oldest, 1))
        .when(time <= now, time)
        .otherwise(now)
    )
