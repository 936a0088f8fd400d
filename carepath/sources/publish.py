"""Month-partitioned output tables: publish, archive, replace.

A run that was broken off can be run again with the same window and run time.
Archived rows are partitioned by the run that took them out and are written once;
published tables go from one version to the next in one step (see versions).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import RefreshWindow, Window, latest_month, refresh_window
from .versions import add_rows, publish_version

RUN = "ArchivedRun"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _write_run(df: DataFrame, archive: str) -> None:
    """Rows of one run as its partition of the archive, replacing it if it is there."""
    spark = df.sparkSession
    df = df.hint("rebalance", F.col(RUN))
    if spark.catalog.tableExists(archive):
        ordered = df.select(*spark.table(archive).columns)
        # insertInto takes the overwrite mode from the session only.
        before = spark.conf.get(OVERWRITE)
        spark.conf.set(OVERWRITE, "dynamic")
        try:
            ordered.write.mode("overwrite").insertInto(archive)
        finally:
            spark.conf.set(OVERWRITE, before)
    else:
        rest = [c for c in df.columns if c != RUN]
        df.select(*rest, RUN).write.mode("errorifexists").partitionBy(RUN).format("parquet").saveAsTable(archive)


def create_table(df: DataFrame, table: str, month: str = "Month") -> None:
    """Output of a full build, replacing the table as a whole."""
    publish_version(df, table, month, whole=True)


def append_rows(df: DataFrame, table: str, month: str = "Month") -> None:
    """Further rows of a table, matched by column name."""
    add_rows(df, table, month)


def stamp(df: DataFrame, run: datetime, column: str = "SnapshotDate") -> DataFrame:
    """Time of the run, passed in, so that a rerun gives the same rows."""
    return df.withColumn(column, F.lit(run.isoformat(sep=" ")).cast("timestamp_ntz"))


def _months(table: DataFrame, month: str, window: Window) -> list[date]:
    # Partition values of a handful of months, not data.
    rows = table.where(F.col(month).between(window.first, window.last)).select(month).distinct()
    return [r[0] for r in rows.collect()]


def _archived(spark: SparkSession, archive: str, run: datetime) -> bool:
    if not spark.catalog.tableExists(archive):
        return False
    return not spark.table(archive).where(F.col(RUN) == run.isoformat()).isEmpty()


def window_of(spark: SparkSession, table: str, month: str = "Month", **kwargs) -> RefreshWindow:
    latest = latest_month(spark.table(table), month) if spark.catalog.tableExists(table) else None
    return refresh_window(latest, **kwargs)


def publish_rolling(
    new: DataFrame,
    table: str,
    archive: str,
    window: RefreshWindow,
    run: datetime,
    month: str = "Month",
) -> None:
    """Archive the months that are taken out, then put the new months in their place.

    The archive has the rows of a run before the table changes, which it does in one step.
    """
    spark = new.sparkSession
    gone = []
    if spark.catalog.tableExists(table):
        current = spark.table(table)
        if not _archived(spark, archive, run):
            leaving = current.where(F.col(month).between(*window.delete))
            _write_run(leaving.withColumn(RUN, F.lit(run.isoformat())), archive)
        gone = _months(current, month, window.delete)
    publish_version(new.where(F.col(month).between(*window.insert)), table, month, gone)


def publish_replacing_latest(
    new: DataFrame, table: str, window: Window, month: str = "Month"
) -> None:
    """The months of ``window`` in place of the newest month, in one step."""
    spark = new.sparkSession
    newest = latest_month(spark.table(table), month) if spark.catalog.tableExists(table) else None
    fresh = new.where(F.col(month).between(*window))
    publish_version(fresh, table, month, [] if newest is None else [newest])
