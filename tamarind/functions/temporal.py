"""Dates, durations and calendar attributes.

Marketplace timestamps carry no zone. They are kept as ``timestamp_ntz`` so a
result never depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions.text import as_col

CLOCK = "timestamp_ntz"


def wall_clock(c: str | Column) -> Column:
    """Any date, timestamp or text as a zone-less timestamp; bad text is null."""
    return as_col(c).try_cast(CLOCK)


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(as_col(end), as_col(start))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))


def hours_between(start: str | Column, end: str | Column, digits: int = 2) -> Column:
    return F.round(seconds_between(start, end) / F.lit(3600), digits)


def plus_days(ts: str | Column, days: int | Column) -> Column:
    """Midnight of the day ``days`` after ``ts``: the time of day is dropped."""
    return F.date_add(as_col(ts), days).cast(CLOCK)


def plus_seconds(ts: str | Column, seconds: int | Column) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return as_col(ts) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def date_key(ts: str | Column) -> Column:
    """``yyyyMMdd`` as an integer, null for null."""
    ts = as_col(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_label(ts: str | Column) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")


def clock_label(ts: str | Column) -> Column:
    return F.date_format(wall_clock(ts), "HH:mm:ss")


def sunday_week(d: str | Column) -> Column:
    """Week of the year, Sunday first; days before the first Sunday are week 0."""
    d = as_col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def calendar_attributes(d: str = "full_date") -> dict[str, Column]:
    """The attributes of a calendar dimension, by name, for a date column."""
    day = F.col(d)
    next_month = F.month(F.date_add(day, 1)) != F.month(day)
    weekend = F.dayofweek(day).isin(1, 7)
    return {
        "date_sk": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_key": F.date_format(day, "MM"),
        "month_name": F.date_format(day, "MMMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "week_of_year": sunday_week(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_type": F.when(weekend, "Weekend").otherwise("Business Day"),
        "is_weekend": weekend,
        "is_business_day": ~weekend,
        "is_month_start": F.dayofmonth(day) == 1,
        "is_month_end": next_month,
        "is_quarter_start": (F.month(day) % 3 == 1) & (F.dayofmonth(day) == 1),
        "is_quarter_end": (F.month(day) % 3 == 0) & next_month,
        "is_year_start": F.dayofyear(day) == 1,
        "is_year_end": (F.month(day) == 12) & (F.dayofmonth(day) == 31),
    }
