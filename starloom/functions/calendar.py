"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(d: str | Column) -> Column:
    return F.col(d) if isinstance(d, str) else d


def date_key(d: str | Column) -> Column:
    """YYYYMMDD as INT (the conventional smart key of a date dimension)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_of_year_monday(d: str | Column) -> Column:
    """Week number 0-53 where weeks start on Monday and days before the first
    Monday of the year fall in week 0 (the C ``%W`` convention, *not* ISO)."""
    d = _c(d)
    # weekday(): Monday = 0 .. Sunday = 6 ; dayofyear(): 1-based
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def month_name(d: str | Column) -> Column:
    """Full English month name (Spark formats with Locale.US)."""
    return F.date_format(_c(d), "MMMM")


def day_name(d: str | Column) -> Column:
    """Full English day name."""
    return F.date_format(_c(d), "EEEE")


def is_weekend(d: str | Column) -> Column:
    """Saturday or Sunday (dayofweek(): Sunday = 1 .. Saturday = 7)."""
    return F.dayofweek(_c(d)).isin(1, 7)
