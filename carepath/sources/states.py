"""Sums per month that are kept from one run to the next.

An output made of sums can be made from sums at a finer level. A store keeps these, one row per
month and key, as a table that goes from version to version in one step (see versions). A run reads
the records of new and changed months only; all other months come from the store, whose unchanged
months are not rewritten either. As the sums are by codes as recorded or at the finest level, an
output whose labels or levels change is made again without reading a record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import Window
from ..operators.states import merge_sums, months_in, of_months, runs_of, sum_by
from .staging import StagedRun
from .tables import era_union
from .versions import notes_of, publish_version

#: Notes of a store: months that were built, also those without rows, and batches that were added.
BUILT, BATCH = "built", "batch."


@dataclass(frozen=True)
class SumStore:
    """Sums of ``measures`` per month and ``keys`` under a table name.

    ``count`` names the measure that counts records, if records can be taken back.
    """

    table: str
    keys: Sequence[str]
    measures: Sequence[str]
    month: str = "Month"
    count: str | None = None

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.table)

    def built(self, spark: SparkSession) -> set[date]:
        """Months that were built, from the catalog: no data are read."""
        if not self.exists(spark):
            return set()
        noted = notes_of(spark, self.table).get(BUILT, "")
        return {date.fromisoformat(m) for m in noted.split(",") if m}

    def batches(self, spark: SparkSession) -> set[str]:
        if not self.exists(spark):
            return set()
        return {n[len(BATCH):] for n in notes_of(spark, self.table) if n.startswith(BATCH)}

    def rows(self, spark: SparkSession, window: Window | None = None) -> DataFrame:
        """The stored sums; with a window, those of its months."""
        df = spark.table(self.table)
        return df if window is None else df.where(of_months(months_in(window), self.month))

    def replace(self, sums: DataFrame, months: Iterable[date]) -> None:
        """Sums of whole months in place of those stored; months without rows become empty."""
        spark, months = sums.sparkSession, set(months)
        built = self.built(spark) | months
        new = sums.where(of_months(months, self.month)).select(
            *[f"`{c}`" for c in (*self.keys, *self.measures, self.month)]
        )
        noted = ",".join(m.isoformat() for m in sorted(built))
        publish_version(new, self.table, self.month, gone=months, notes={BUILT: noted})

    def update(
        self, spark: SparkSession, build: Callable[[Window], DataFrame], window: Window, changed: Iterable[date] = ()
    ) -> list[date]:
        """Build the months of the window that are missing or named as changed. Gives these months.

        ``build`` gets windows of whole neighbouring months and reads no others.
        """
        wanted = set(months_in(window))
        named = {m.replace(day=1) for m in changed}
        months = sorted((wanted - self.built(spark)) | (wanted & named))
        if months:
            self.replace(era_union(*[build(w) for w in runs_of(months)]), months)
        return months

    def add(self, delta: DataFrame, batch: str) -> bool:
        """Add the sums of further records to the months that they belong to.

        The name of the batch is noted in the same step, so a run that is repeated adds nothing
        twice. Only the months of the batch are read and written. Gives whether it was added.
        """
        spark = delta.sparkSession
        if not re.fullmatch(r"[\w.:-]+", batch):
            raise ValueError(f"a batch is named by letters, digits and ._:- only, not {batch!r}")
        if not self.exists(spark):
            raise ValueError(f"{self.table} has no months yet: build them first")
        if batch in self.batches(spark):
            return False
        with StagedRun(spark) as staged:
            late = staged.table(batch, lambda: sum_by(delta, self.keys, self.measures, self.month), "late-sums")
            months = [r[0] for r in late.select(self.month).distinct().collect()]  # a handful
            unbuilt = {m for m in months if m is not None} - self.built(spark)
            if unbuilt:
                raise ValueError(f"months not in {self.table}: {sorted(unbuilt)}; build them from the records")
            merged = merge_sums(
                spark.table(self.table).where(of_months(months, self.month)), late,
                self.keys, self.measures, self.month, self.count,
            )
            gone = [m for m in months if m is not None]
            publish_version(merged, self.table, self.month, gone=gone, notes={BATCH + batch: "added"})
        return True
