"""Sums per month and key that are merged instead of being built anew."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import Window, end_of_month, months_from, shift_months


def of_months(months: Iterable[date | None], month: str = "Month") -> Column:
    """Rows of these months; a literal list, so partitions of other months aren't read."""
    months = list(months)
    known = [m for m in months if m is not None]
    test = F.col(month).isin(known) if known else F.lit(False)
    return test | F.col(month).isNull() if len(known) < len(months) else test


def months_in(window: Window) -> list[date]:
    """First days of the months of a window; none if it ends before it begins."""
    first, last = window
    return months_from(first, max(0, (last.year - first.year) * 12 + last.month - first.month + 1))


def runs_of(months: Iterable[date]) -> list[Window]:
    """The months as few windows: neighbours are read together."""
    out: list[Window] = []
    for m in sorted(set(months)):
        if out and shift_months(out[-1].last.replace(day=1), 1) == m:
            out[-1] = Window(out[-1].first, end_of_month(m))
        else:
            out.append(Window(m, end_of_month(m)))
    return out


def sum_by(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], month: str = "Month") -> DataFrame:
    """Measures per month and key, in the types that they came in."""
    kinds = {m: rows.schema[m].dataType for m in measures}
    return rows.groupBy(month, *[F.col(f"`{k}`") for k in keys]).agg(
        *[F.sum(F.col(f"`{m}`")).cast(kind).alias(m) for m, kind in kinds.items()]
    )


def merge_sums(
    stored: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    month: str = "Month",
    count: str | None = None,
) -> DataFrame:
    """Stored sums with those of further records; negative sums take records back.

    ``count`` names the measure that counts records: keys without any record left go, as a full
    build would not have them. NULL is a key like any other.
    """
    columns = [F.col(f"`{c}`") for c in [month, *keys, *measures]]
    out = sum_by(stored.select(*columns).unionByName(delta.select(*columns)), keys, measures, month)
    return out if count is None else out.where(F.col(f"`{count}`") != 0)
