"""Date expressions with the conventions of the lodging model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the closed end of a period that still runs.
OPEN_END = "9999-12-31"


def weekday(day: str | Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: str | Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))


def date_key(day: str | Column) -> Column:
    """Integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def years_between(start: str | Column, end: str | Column) -> Column:
    """Calendar-year boundaries crossed, not completed years."""
    return F.year(end) - F.year(start)
