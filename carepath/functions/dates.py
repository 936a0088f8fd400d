"""Date arithmetic for monthly reporting.

Column helpers cast to a calendar date first, so a timestamp late on the last
day of a period still falls inside it. The window helpers are plain Python: a
refresh computes its bounds once, and every filter then carries literal dates
that reach the Parquet scan.
"""

from __future__ import annotations

import calendar
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(c: Column | str) -> Column:
    return F.col(c).cast("date") if isinstance(c, str) else c.cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_date(c), "MM")


def month_end(c: Column | str) -> Column:
    return F.last_day(as_date(c))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; negative when end comes first."""
    return F.datediff(as_date(end), as_date(start))


def in_range(c: Column | str, first: date | Column, last: date | Column) -> Column:
    """Inclusive date range on the calendar date of ``c``."""
    return as_date(c).between(first, last)


def local_time(c: Column | str, zone: str | None, source_zone: str = "UTC") -> Column:
    """Wall-clock time of a UTC timestamp in ``zone``; unchanged when zone is None."""
    c = F.col(c) if isinstance(c, str) else c
    if zone is None:
        return c
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), c.cast("timestamp_ntz"))


# -- plain Python windows -----------------------------------------------------


class Window(NamedTuple):
    """An inclusive span of dates."""

    first: date
    last: date


class RefreshWindow(NamedTuple):
    """Span whose rows are archived, and span that is computed afresh."""

    delete: Window
    insert: Window


def shift_months(d: date, n: int) -> date:
    """Calendar month shift; the day is clamped to the end of the target month."""
    years, month0 = divmod(d.year * 12 + d.month - 1 + n, 12)
    last = calendar.monthrange(years, month0 + 1)[1]
    return date(years, month0 + 1, min(d.day, last))


def end_of_month(d: date) -> date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def months_from(first: date, count: int) -> list[date]:
    return [shift_months(first.replace(day=1), i) for i in range(count)]


def refresh_window(
    max_month: date | None,
    delete_months: int = 11,
    insert_months: int = 12,
    start_month: date | None = None,
) -> RefreshWindow:
    """Bounds of a rolling refresh, from the latest month already published.

    The latest ``delete_months`` months are taken out; ``insert_months`` months
    are put in, the last being the month after the latest one. An empty table has
    no latest month, so the first load must name ``start_month``.
    """
    if max_month is None:
        if start_month is None:
            raise ValueError("the output table is empty: start_month is required")
        first = start_month.replace(day=1)
        last = end_of_month(shift_months(first, insert_months - 1))
        return RefreshWindow(Window(first, first - timedelta(days=1)), Window(first, last))
    latest = max_month.replace(day=1)
    newest = shift_months(latest, 1)
    return RefreshWindow(
        Window(shift_months(latest, 1 - delete_months), end_of_month(latest)),
        Window(shift_months(newest, 1 - insert_months), end_of_month(newest)),
    )


def month_bounds(df: DataFrame, day: str) -> Window:
    """First day of the earliest month and last day of the latest one, from one aggregate."""
    low, high = df.agg(F.min(month_start(day)), F.max(month_end(day))).first()
    return Window(low, high)


def latest_month(df: DataFrame, month: str) -> date | None:
    """Latest month present, from a one-row aggregate over that one column."""
    return df.agg(F.max(month_start(month)).alias("m")).first()[0]
