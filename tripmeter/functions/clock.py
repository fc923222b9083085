"""Timestamps: parsing, local time, elapsed minutes and calendar parts.

``*_utc`` columns are instants (TIMESTAMP), ``*_local`` columns are wall clocks
(TIMESTAMP_NTZ).  In a session whose zone is UTC both turn into each other unchanged; in any
other zone the arithmetic would be wrong, so it fails at once.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Weekday names, Monday = 0.
WEEKDAY_LABELS = {0: "Mon", 1: "Tue", 2: "Wed", 3: "Thu", 4: "Fri", 5: "Sat", 6: "Sun"}


UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00"}


def require_utc() -> None:
    """Fail unless the session zone is UTC."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else "UTC"
    if zone not in UTC_ZONES:
        raise RuntimeError(f"the session zone is {zone}; wall-clock arithmetic needs UTC (tripmeter.session.prepare)")


def _micros(ts: Column) -> Column:
    require_utc()
    return F.unix_micros(ts.cast("timestamp"))


def parse_wall_clock(value: Column) -> Column:
    """Text or timestamp to TIMESTAMP_NTZ; anything unreadable becomes NULL."""
    return value.try_cast("timestamp_ntz")


def utc_to_local(ts_utc: Column, offset_hours: int) -> Column:
    """Wall clock of a zone that lies a fixed number of hours behind UTC (no DST)."""
    require_utc()
    interval = F.make_dt_interval(F.lit(0), F.lit(offset_hours))
    return parse_wall_clock(ts_utc) - interval


def minutes_between(later: Column, earlier: Column) -> Column:
    """Signed minutes from ``earlier`` to ``later``."""
    return (_micros(later) - _micros(earlier)) / F.lit(60_000_000.0)


def elapsed_minutes(end_local: Column, start_utc: Column, local_offset_hours: int = 0) -> Column:
    """Minutes from a UTC start to a local end.

    With offset 0 the local wall clock is read as if it were UTC, which is how the
    snapshot defines its duration; the true offset gives the corrected duration.
    """
    return minutes_between(end_local, start_utc) + F.lit(60.0 * local_offset_hours)


def as_date(value: Column) -> Column:
    return F.to_date(value)


def days_before(day: Column | str, days: int) -> Column:
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return F.date_sub(day, days)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekday_number(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def weekday_label(number: Column) -> Column:
    pairs = [F.lit(part) for item in WEEKDAY_LABELS.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), number)


def weekend_flag(ts: Column) -> Column:
    return weekday_number(ts).isin(5, 6).cast("int")


def hour_angle(hour: Column) -> tuple[Column, Column]:
    """Sine and cosine of the hour on a 24-hour dial."""
    angle = hour * (2 * F.pi() / 24)
    return F.sin(angle), F.cos(angle)


def three_hour_slot(hour: Column) -> Column:
    return F.floor(hour / 3).cast("int")


def flag(condition: Column) -> Column:
    """0/1 for a comparison; a missing operand counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")
