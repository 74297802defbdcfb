"""Timestamp helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros_to_ntz(micros: Column) -> Column:
    """UTC wall clock for a count of microseconds since 1970-01-01."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def to_utc_ntz(ts: Column) -> Column:
    """Drop the zone of an instant, keeping its UTC wall clock."""
    return micros_to_ntz(F.unix_micros(ts))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Signed difference of two zone-less timestamps in seconds, as double."""
    return (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")
