"""Naive-UTC time arithmetic. The session zone has to be UTC (see ``session.use_utc``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NTZ = "timestamp_ntz"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a naive UTC time."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast(NTZ)


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts).cast(NTZ)


def hour_index(ts: Column) -> Column:
    """Hours since 1970; consecutive on a regular hourly series."""
    return F.floor(epoch_seconds(ts) / 3600).cast("bigint")


def day_index(ts: Column) -> Column:
    return F.unix_date(ts.cast("date"))


def round_to_hours(ts: Column, hours: int) -> Column:
    """Nearest multiple of ``hours``; an exact tie goes to the even multiple."""
    step = hours * 3600
    slots = F.rint(epoch_micros(ts) / (step * 1e6)).cast("bigint")
    return from_epoch_seconds(slots * step)


def to_local(ts: Column, tz: Column) -> Column:
    """Wall-clock time in zone ``tz`` of a naive UTC time."""
    return F.convert_timezone(F.lit("UTC"), tz, ts)


def to_utc(ts: Column, tz: Column) -> Column:
    """Naive UTC time of a wall-clock time in zone ``tz``."""
    return F.convert_timezone(tz, F.lit("UTC"), ts)


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n), F.lit(0), F.lit(0))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Month, hour and weekday (Monday = 0)."""
    return {"month": F.month(ts), "hour": F.hour(ts), "weekday": F.weekday(ts)}
