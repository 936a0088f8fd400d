"""Waiting times and caseload status of a referral within a reporting period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import as_date, days_between


def flag(predicate: Column) -> Column:
    """0/1; an unknown predicate counts as 0."""
    return F.when(predicate, 1).otherwise(0)


def wait_days(start: Column | str, end: Column | str, as_of: Column | str) -> Column:
    """Days from start to end, if the end is not before the start nor after ``as_of``."""
    start, end, as_of = as_date(start), as_date(end), as_date(as_of)
    return F.when((end >= start) & (end <= as_of), days_between(start, end))


def in_period(event: Column | str, first: Column | str, last: Column | str) -> Column:
    return flag(as_date(event).between(as_date(first), as_date(last)))


def is_open(discharged: Column | str, period_end: Column | str) -> Column:
    discharged = as_date(discharged)
    return discharged.isNull() | (discharged > as_date(period_end))


def caseload_flags(
    received: Column | str,
    discharged: Column | str,
    first_contact: Column | str,
    period_start: Column | str,
    period_end: Column | str,
    care_plan: Column | str | None = None,
) -> dict[str, Column]:
    """New, discharged, open, open and not yet seen, open with a care plan."""
    open_ = is_open(discharged, period_end)
    contact = as_date(first_contact)
    flags = {
        "NewRef": in_period(received, period_start, period_end),
        "DischRef": in_period(discharged, period_start, period_end),
        "OpenRef": flag(open_),
        "Refwaiting1stcontact": flag(
            open_ & (contact.isNull() | (contact > as_date(period_end)))
        ),
    }
    if care_plan is not None:
        flags["RefwithCarePlanCreated"] = flag(open_ & (as_date(care_plan) <= as_date(period_end)))
    return flags
