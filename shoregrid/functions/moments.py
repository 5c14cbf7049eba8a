"""Time expressions. Inputs without zone stay without zone (`timestamp_ntz` in, `timestamp_ntz` out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_HOUR = "INTERVAL '30' MINUTE"


def truncate(unit: str, ts: Column, ntz: bool = True) -> Column:
    """`date_trunc` that keeps the zone-less type (the built-in returns a zoned one)."""
    cut = F.date_trunc(unit, ts)
    return cut.cast("timestamp_ntz") if ntz else cut


def nearest_hour(ts: Column, ntz: bool = True) -> Column:
    """The closest full hour; half past goes up."""
    return truncate("HOUR", ts + F.expr(HALF_HOUR), ntz)


def half_hour(ts: Column) -> Column:
    """Start of the half hour; keeps the type."""
    return F.window(ts, "30 minutes")["start"]


def micros(ts: Column) -> Column:
    """Whole microseconds since 1970, so that times can be subtracted and bucketed exactly."""
    return F.unix_micros(ts.cast("timestamp"))


def observation_time(
    year: Column, month: Column, day: Column, hour: Column, minute: Column | None = None
) -> Column:
    """UTC time from text or number parts; NULL for impossible dates; minutes of 60 or more count as 0."""
    parts = [p.try_cast("int") for p in (year, month, day, hour)]
    if minute is None:
        minutes = F.lit(0)
    else:
        value = minute.try_cast("int")
        minutes = F.when(value >= 60, F.lit(0)).otherwise(value)
    return F.try_make_timestamp(*parts, minutes, F.lit(0).cast("decimal(16,6)"))


def compact_hour(text: Column) -> Column:
    """``yyyyMMddHH`` as UTC time."""
    return F.try_to_timestamp(text, F.lit("yyyyMMddHH"))


def iso_day(text: Column) -> Column:
    """``yyyy-MM-dd`` as the UTC midnight that starts the day."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))


def zoned_minute(text: Column, offset: str = "+00:00") -> Column:
    """``yyyy-MM-dd HH:mm`` at a fixed offset."""
    return F.try_to_timestamp(F.concat(text, F.lit(offset)), F.lit("yyyy-MM-dd HH:mmXXX"))


def overlaps(start: Column, end: Column, query_start: Column, query_end: Column) -> Column:
    """Closed intervals share at least one instant."""
    return (start <= query_end) & (end >= query_start)


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def year_slices(start: Column, end: Column) -> Column:
    """Cut [start, end] into slices as long as the calendar year each one starts in.

    Array of ``struct(slice_start, slice_end)``; every slice but the last stops one microsecond
    before its successor, the last one stops at ``end``.
    """
    day = F.expr("INTERVAL '1' DAY")
    tick = F.expr("INTERVAL '0.000001' SECOND")
    steps = F.greatest(F.ceil(F.datediff(end, start) / 365.0), F.lit(0)) + 1

    def extend(starts: Column, _: Column) -> Column:
        last = F.element_at(starts, -1)
        days = F.when(is_leap(F.year(last)), F.lit(366)).otherwise(F.lit(365))
        return F.concat(starts, F.array(last + day * days))

    starts = F.aggregate(F.sequence(F.lit(1), steps), F.array(start), extend)
    kept = F.filter(starts, lambda s, i: (i == 0) | (s < end))
    return F.transform(
        kept,
        lambda s, i: F.struct(
            s.alias("slice_start"),
            F.coalesce(F.get(kept, i + 1) - tick, end).alias("slice_end"),
        ),
    )
