"""Refresh runs: published table -> window -> job restricted to it -> publish.

A run broken off at any point is run again with the window that the first attempt
returned (or logged) and the same run time; the result is the same as of one run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import RefreshWindow, Window
from ..sources.publish import publish_replacing_latest, publish_rolling, window_of
from ..sources.staging import StagedRun
from ..sources.states import SumStore
from ..sources.tables import Tables
from .admissions import CODES, COUNTS, admission_sums, admissions
from .readmissions import readmissions
from .referral_pathway import (
    METRIC_KEYS,
    METRICS,
    PLACES,
    main_metrics,
    metric_sums,
    metrics_from_sums,
    pathway_outputs,
    referral_base,
)

Job = Callable[[Window], DataFrame]


def refresh_rolling(
    spark: SparkSession,
    job: Job,
    table: str,
    archive: str,
    run: datetime,
    window: RefreshWindow | None = None,
    month: str = "Month",
    **bounds,
) -> RefreshWindow:
    """Build the months of the window, archive those they replace, publish. Gives the window.

    ``bounds`` are those of ``refresh_window``; the first load needs ``start_month``.
    """
    window = window or window_of(spark, table, month, **bounds)
    publish_rolling(job(window.insert), table, archive, window, run, month)
    return window


def refresh_latest(
    spark: SparkSession,
    job: Job,
    table: str,
    window: RefreshWindow | None = None,
    month: str = "Month",
    **bounds,
) -> RefreshWindow:
    """Replace the newest month and add the next ones, without an archive."""
    window = window or window_of(spark, table, month, **{"delete_months": 1, "insert_months": 2, **bounds})
    publish_replacing_latest(job(window.insert), table, window.insert, month)
    return window


def refresh_admissions(
    spark: SparkSession, tables: Tables, table: str, archive: str, run: datetime,
    splits: DataFrame | None = None, **options,
) -> RefreshWindow:
    return refresh_rolling(
        spark, lambda months: admissions(tables, months, run, splits), table, archive, run, **options
    )


def refresh_readmissions(
    spark: SparkSession, tables: Tables, table: str, archive: str, run: datetime,
    splits: DataFrame | None = None, **options,
) -> RefreshWindow:
    def job(months: Window) -> DataFrame:
        count = (months.last.year - months.first.year) * 12 + months.last.month - months.first.month + 1
        return readmissions(tables, months.first, run, count, splits=splits)

    return refresh_rolling(spark, job, table, archive, run, **options)


def refresh_metrics(
    spark: SparkSession, tables: Tables, table: str, run: datetime, **options
) -> RefreshWindow:
    return refresh_latest(
        spark, lambda months: main_metrics(referral_base(tables, months), run), table, **options
    )


def refresh_pathway(
    spark: SparkSession, tables: Tables, waits: str, metrics: str, run: datetime,
    window: RefreshWindow | None = None, **bounds,
) -> RefreshWindow:
    """Both referral outputs of one run from one base, which is gone afterwards."""
    window = window or window_of(spark, metrics, **{"delete_months": 1, "insert_months": 2, **bounds})
    with StagedRun(spark) as staged:
        for frame, table in zip(pathway_outputs(tables, window.insert, run, staged), (waits, metrics), strict=True):
            publish_replacing_latest(frame, table, window.insert)
    return window


def admission_store(table: str) -> SumStore:
    """Sums of admissions by raw codes."""
    return SumStore(table, [c for c in CODES if c != "Month"], list(COUNTS), count="Emergency Admissions")


def metric_store(table: str) -> SumStore:
    """Sums of caseload at the finest levels, described when their months were built."""
    return SumStore(table, [*[k for k in METRIC_KEYS if k != "Month"], "Level", *PLACES, "Category", "Variable"], list(METRICS))


def refresh_admissions_stored(
    spark: SparkSession, tables: Tables, store: SumStore, table: str, archive: str, run: datetime,
    splits: DataFrame | None = None, changed: Iterable[date] = (), **options,
) -> RefreshWindow:
    """A rolling refresh that reads the records of new and changed months only.

    ``changed`` names the months whose records differ from what is stored. The rows are those
    of ``refresh_admissions``, with organisations and labels as they are now.
    """
    changed = list(changed)

    def job(months: Window) -> DataFrame:
        store.update(spark, lambda part: admission_sums(tables, part), months, changed)
        return admissions(tables, months, run, splits, sums=store.rows(spark, months))

    return refresh_rolling(spark, job, table, archive, run, **options)


def refresh_metrics_stored(
    spark: SparkSession, tables: Tables, store: SumStore, table: str, run: datetime,
    changed: Iterable[date] = (), **options,
) -> RefreshWindow:
    """Metrics with records of new and changed months only; stored months keep their labels."""
    changed = list(changed)

    def job(months: Window) -> DataFrame:
        store.update(spark, lambda part: metric_sums(referral_base(tables, part)), months, changed)
        return metrics_from_sums(store.rows(spark, months), run)

    return refresh_latest(spark, job, table, **options)
