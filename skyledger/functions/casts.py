"""Conversions that yield NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# First and last second of the years 1 to 9999, the range of a timestamp.
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799


def to_whole(number: Column) -> Column:
    """Decimal to int: fractions are cut off, what does not fit is NULL.  They are cut off
    before the cast, which takes a wide decimal through its text and a double: that is slow
    and rounds 0.999999999999999999 up."""
    return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast("int")


def epoch_to_utc(number: Column) -> Column:
    """Epoch seconds to the UTC wall clock, whatever the session zone is."""
    seconds = number.try_cast("bigint")
    in_range = F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), seconds)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=in_range.cast("decimal(18,6)"))


def utc_now() -> Column:
    """Query start as a UTC wall clock; one value per query."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
