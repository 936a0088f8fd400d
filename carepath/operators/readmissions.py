"""Readmissions: an admission in a month after a discharge shortly before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, days_between, month_start, shift_months
from .events import first_row


def lookback_months(
    day: Column | str, first_month: date, n_months: int, lookback: int = 90
) -> Column:
    """Months (as an array) whose look-back window of days holds the date.

    The window of a month is the ``lookback`` days before its first day, so a date
    belongs to the month starts in (day, day + lookback]: a handful, found by
    arithmetic instead of a join with the list of months.
    """
    day = as_date(day)
    nxt = F.add_months(month_start(day), 1)
    until = F.date_add(day, lookback)
    starts = F.sequence(nxt, F.greatest(nxt, until), F.expr("interval 1 month"))
    last = shift_months(first_month, n_months - 1)
    return F.filter(
        starts, lambda m: (m <= until) & (m >= F.lit(first_month)) & (m <= F.lit(last))
    )


def readmission_pairs(
    discharges: DataFrame,
    admissions: DataFrame,
    person: str,
    discharge_date: str,
    admission_date: str,
    first_month: date,
    n_months: int = 12,
    lookback: int = 90,
    pick: str = "earliest",
    discharge_order: Sequence[Column] = (),
    admission_order: Sequence[Column] = (),
    discharge_carry: Sequence[str] = (),
    admission_carry: Sequence[str] = (),
    month: str = "Month",
    gap: str = "TimeBetweenAdmissions",
) -> DataFrame:
    """One discharge and one admission per person and month, and the days between.

    For each month: the person's ``pick`` discharge of the days before it, and the
    first admission within it. All months are one set-based job. Both picks are
    aggregates, and the join that follows sees one row per person and month.
    """
    if pick not in ("earliest", "latest"):
        raise ValueError("pick is 'earliest' or 'latest'")
    left = (
        discharges.where(F.col(person).isNotNull())
        .withColumn(discharge_date, as_date(discharge_date))
        .where(
            F.col(discharge_date).between(
                F.date_sub(F.lit(first_month), lookback),
                F.date_sub(F.lit(shift_months(first_month, n_months - 1)), 1),
            )
        )
        .withColumn(
            month, F.explode(lookback_months(discharge_date, first_month, n_months, lookback))
        )
    )
    by_date = F.unix_date(discharge_date)
    order = [by_date if pick == "earliest" else -by_date, *discharge_order]
    left = first_row(left, [month, person], order, [discharge_date, *discharge_carry])
    right = (
        admissions.where(F.col(person).isNotNull())
        .withColumn(month, month_start(admission_date))
        .where(
            F.col(month).between(
                F.lit(first_month), F.lit(shift_months(first_month, n_months - 1))
            )
        )
    )
    right = first_row(
        right, [month, person], [F.col(admission_date), *admission_order],
        [admission_date, *admission_carry],
    ).withColumn(admission_date, as_date(admission_date))
    both = left.join(right, [month, person], "inner")
    return both.withColumn(gap, days_between(discharge_date, admission_date))


def bucket_columns(
    gap: str,
    flags: Mapping[str, str | None],
    edges: Sequence[int] = (30, 60, 90),
    empty_as_null: bool = False,
    prefix: str = "Readmissions",
) -> dict[str, Column]:
    """Sums per flag and bucket; a None flag counts every pair.

    Gaps beyond the last edge are in no bucket. ``empty_as_null`` leaves a bucket
    without pairs NULL instead of 0.
    """
    out, low = {}, None
    for edge in edges:
        g = F.col(gap)
        hit = g <= edge if low is None else g.between(low + 1, edge)
        for name, column in flags.items():
            one = F.when(hit, F.lit(1) if column is None else F.col(column))
            total = F.sum(one if empty_as_null else one.otherwise(0))
            out[f"{name} - {prefix}{edge}days"] = total
        low = edge
    return out
