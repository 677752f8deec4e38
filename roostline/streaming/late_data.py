"""The rolling reprocess window and the check for rows that arrive behind it."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Days an incremental run loads again, hours that count as freshly loaded.
WINDOW_DAYS = 7
LOOKBACK_HOURS = 48


def reprocess_bound(
    fact: DataFrame, window_days: int = WINDOW_DAYS, month: datetime.date | None = None
) -> datetime.date | None:
    """First date an incremental run loads again, or None for an empty fact.

    Only the latest month is read for its last date. A caller that knows that month, as from
    the names of a table's folders, gives it; else it is looked up first.
    """
    if month is None:
        month = fact.agg(F.max("calendar_month")).first()[0]
    if month is None:
        return None
    newest = fact.filter(F.col("calendar_month") == F.lit(month)).agg(F.max("calendar_date"))
    return newest.first()[0] - datetime.timedelta(days=window_days)


def check_late_arrivals(
    calendar: DataFrame,
    fact: DataFrame,
    as_of: datetime.datetime | str,
    window_days: int = WINDOW_DAYS,
    lookback_hours: int = LOOKBACK_HOURS,
) -> DataFrame:
    """One row ``late_count``: raw nights older than the window but loaded recently.

    The count is 0 when the calendar has no ``_loaded_at`` or the fact is empty.
    """
    if "_loaded_at" not in calendar.columns:
        return calendar.sparkSession.range(1).select(F.lit(0).cast("long").alias("late_count"))
    newest = fact.agg(F.max("calendar_date"))
    loaded_since = F.lit(str(as_of)).cast("timestamp") - F.make_interval(
        hours=F.lit(lookback_hours)
    )
    return (
        calendar.filter(F.col("_loaded_at") >= loaded_since)
        .filter(F.col("date").cast("date") < F.date_sub(newest.scalar(), window_days))
        .agg(F.count(F.lit(1)).alias("late_count"))
    )
