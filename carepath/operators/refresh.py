"""Refresh of a published table as plain DataFrames: what stays, what leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import RefreshWindow, Window, month_start


def leaving(current: DataFrame, window: RefreshWindow, month: str = "Month") -> DataFrame:
    """Rows to archive."""
    return current.where(F.col(month).between(*window.delete))


def roll(
    current: DataFrame, new: DataFrame, window: RefreshWindow, month: str = "Month"
) -> tuple[DataFrame, DataFrame]:
    """The table after one rolling refresh, and the rows it gave up."""
    outside = F.col(month).isNull() | ~F.col(month).between(*window.delete)
    fresh = new.where(F.col(month).between(*window.insert))
    return current.where(outside).unionByName(fresh), leaving(current, window, month)


def replace_latest(
    current: DataFrame, new: DataFrame, insert: Window, month: str = "Month"
) -> DataFrame:
    """The table without its newest month, plus the months of ``insert``."""
    newest = current.agg(F.max(month)).scalar()
    kept = current.where(F.col(month).isNull() | (F.col(month) != newest))
    return kept.unionByName(new.where(F.col(month).between(*insert)))


def period_filter(df: DataFrame, date: str, window: Window) -> DataFrame:
    return df.where(F.col(date).cast("date").between(*window))


def monthly_counts(df: DataFrame, spine: DataFrame, date: str, month: str = "Month") -> DataFrame:
    """Facts per month of the spine, with zero for months without any."""
    counts = df.groupBy(month_start(date).alias(month)).agg(F.count("*").alias("n"))
    return spine.join(counts, month, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
