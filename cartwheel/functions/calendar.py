"""Calendar expressions. Weeks start on Monday and are DATE values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_strict(c) -> Column:
    """Parse to a timestamp; malformed text gives null instead of failing the job."""
    return F.try_to_timestamp(_col(c).cast("string"))


def week_start(c) -> Column:
    """Monday of the week of a date or timestamp."""
    return F.trunc(_col(c).cast("date"), "week")


def week_start_ts(c) -> Column:
    """Monday of the week, keeping the time of day of a timestamp."""
    return _col(c) - F.make_dt_interval(F.weekday(_col(c)))


def next_week(c) -> Column:
    return F.date_add(_col(c), 7)


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def month_number(c) -> Column:
    return F.month(_col(c))


def iso_week(c) -> Column:
    return F.weekofyear(_col(c))


def yyyymmdd(c) -> Column:
    return F.date_format(_col(c), "yyyyMMdd")
