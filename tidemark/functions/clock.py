"""Time columns as integer microseconds, and wall-clock conversion."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def instant(us: Column | str) -> Column:
    return F.timestamp_micros(F.col(us) if isinstance(us, str) else us)


def to_us(moment: datetime | str) -> int:
    """Driver-side instant in microseconds; naive values are UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment - EPOCH
    return (delta.days * 86400 + delta.seconds) * SECOND_US + delta.microseconds


def from_us(us: int) -> datetime:
    return EPOCH + timedelta(microseconds=us)


def instant_lit(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def minute_floor_us(us: int) -> int:
    return us - us % (60 * SECOND_US)


def wall_clock_to_instant(wall: Column, zone: Column) -> Column:
    """Local wall-clock time in ``zone`` as an instant.

    A wall time that occurs twice (autumn overlap) is read as the later one,
    so the candidate an hour (or, in half-hour zones, 30 minutes) further on
    is taken whenever it still shows the same wall time.
    """
    as_ts = wall.cast("timestamp")
    first = F.to_utc_timestamp(as_ts, zone)
    hour = first + F.expr("INTERVAL 1 HOUR")
    half = first + F.expr("INTERVAL 30 MINUTES")
    return (
        F.when(F.from_utc_timestamp(hour, zone) == as_ts, hour)
        .when(F.from_utc_timestamp(half, zone) == as_ts, half)
        .otherwise(first)
    )
