"""Calendar arithmetic that the built-in functions do not spell directly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: any instant before all data; minutes are counted from it.
_ORIGIN = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def minute_steps(start: Column, end: Column) -> Column:
    """Number of minute marks crossed between two timestamps (00:00:59 -> 00:01:01 is 1)."""
    origin = F.expr(_ORIGIN)
    return F.timestamp_diff("MINUTE", origin, end) - F.timestamp_diff("MINUTE", origin, start)


def week_start(day: Column, shift: int = 0) -> Column:
    """First day of the week of ``day`` when weeks start ``shift`` days after Monday."""
    return F.date_add(F.date_trunc("week", F.date_sub(day, shift)).cast("date"), shift)


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday .. 6 for Saturday."""
    return F.dayofweek(day) - 1


def month_label(day: Column) -> Column:
    """``Jan-24``."""
    return F.date_format(day, "MMM-yy")


def year_month(day: Column) -> Column:
    """``202401``."""
    return F.date_format(day, "yyyyMM")


def in_year(day: Column, year: int) -> Column:
    """True from 1 January of the year on and before that of the next: a range, which a scan can use."""
    return (day >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (day < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def clock(ts: Column) -> Column:
    """Time of day as ``HH:mm:ss`` text; Spark has no portable time type."""
    return F.date_format(ts, "HH:mm:ss")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
