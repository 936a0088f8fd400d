"""Repeated keys of reference tables, found while a job reads them.

A key that repeats in a reference table multiplies the facts that have it. A guard watches every
reference table that a job's joins meet: its rows are counted per key and the repeated ones are
measured in the same pass that feeds the join.

    with KeyGuard() as guard:
        out = admissions(tables, window, run)
    guard.repeated  # {"Org_Code -> __successor": Repeat(rows=2, example="Q1")}
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage


class Repeat(NamedTuple):
    rows: int
    example: str


class KeyGuard:
    """Watches the joins of the jobs that are planned inside its ``with`` block.

    A watched table is staged: one pass counts its keys and writes what the joins then read, as
    often as they need it. ``on_repeat="raise"`` stops the job at the first repeated key;
    ``"report"`` lets it run and ``repeated`` tells.
    """

    active: list[KeyGuard] = []

    def __init__(self, on_repeat: str = "report"):
        if on_repeat not in ("report", "raise"):
            raise ValueError("on_repeat is 'report' or 'raise'")
        self.on_repeat = on_repeat
        self.watched: list[str] = []
        self.repeated: dict[str, Repeat] = {}

    def __enter__(self) -> KeyGuard:
        KeyGuard.active.append(self)
        return self

    def __exit__(self, *_) -> None:
        KeyGuard.active.remove(self)

    def watch(self, reference: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        shown = F.concat_ws(" / ", *[F.col(k).cast("string") for k in keys])
        matches = F.lit(True)  # a NULL key matches nothing
        for k in keys:
            matches = matches & F.col(k).isNotNull()
        again = matches & (F.count("*").over(W.partitionBy(*keys)) > 1)
        note = Observation()
        counted = reference.withColumn("__again", again).observe(
            note, F.count_if("__again").alias("rows"), F.min(F.when(F.col("__again"), shown)).alias("example")
        )
        kept = stage(counted.drop("__again"), "reference")
        self.watched.append(name)
        if note.get["rows"]:
            self.repeated[name] = Repeat(note.get["rows"], note.get["example"])
            if self.on_repeat == "raise":
                raise ValueError(f"repeated key of {name}: {note.get['example']}")
        return kept


def watched(reference: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The reference table, under the guard in whose block this is called, if any."""
    return KeyGuard.active[-1].watch(reference, keys, name) if KeyGuard.active else reference
