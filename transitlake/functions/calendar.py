"""Agency-local calendar. The timezone is a column, the session timezone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(instant: Column, tz: Column) -> Column:
    return F.from_utc_timestamp(instant, tz)


def local_date(instant: Column, tz: Column) -> Column:
    return F.to_date(local_time(instant, tz))


def local_date_text(instant: Column, tz: Column) -> Column:
    return F.date_format(local_time(instant, tz), "yyyy-MM-dd")


def local_hour_text(instant: Column, tz: Column) -> Column:
    return F.date_format(local_time(instant, tz), "HH")


def day_start(date: Column, tz: Column) -> Column:
    """First instant of a local day; days with a clock change last 23 or 25 hours."""
    return F.to_utc_timestamp(F.to_date(date).cast("timestamp"), tz)


def day_end(date: Column, tz: Column) -> Column:
    return day_start(F.date_add(F.to_date(date), 1), tz)


def millis_between(later: Column, earlier: Column) -> Column:
    """Whole milliseconds, rounded towards zero."""
    return ((F.unix_micros(later) - F.unix_micros(earlier)) / 1000).cast("bigint")
