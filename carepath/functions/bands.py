"""Numeric bands."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Band(NamedTuple):
    """Inclusive bounds; None leaves that side open."""

    low: float | None
    high: float | None
    label: str


# Published band edges and labels.
AGE_BANDS = [
    Band(None, 64, "Under65"),
    Band(65, 74, "65to74"),
    Band(75, 84, "75to84"),
    Band(85, None, "85+"),
]
AGE_UNKNOWN = "Unknown/Not Stated"

STAY_BANDS = [
    Band(None, 1, "1 Day or less"),
    Band(2, 3, "Between 2 and 3 Days"),
    Band(4, 10, "Between 4 and 10 Days"),
    Band(11, 21, "Between 11 and 21 Days"),
    Band(22, None, "More than 21 Days"),
]

WAIT_BANDS = [
    Band(None, 42, "Under6weeksNumber"),
    Band(43, 126, "6to18weeksNumber"),
    Band(127, None, "Over18weeksNumber"),
]


def within(c: Column, band: Band) -> Column:
    if band.low is None:
        return c <= band.high
    if band.high is None:
        return c >= band.low
    return c.between(band.low, band.high)


def band_label(c: Column | str, bands: Sequence[Band], default: str | None = None) -> Column:
    """Label of the band; values in no band, and NULL, give ``default``."""
    c = F.col(c) if isinstance(c, str) else c
    out = F
    for band in bands:
        out = out.when(within(c, band), F.lit(band.label))
    return out.otherwise(F.lit(default))


def band_flags(
    c: Column | str,
    prefix: str,
    bands: Sequence[Band] = WAIT_BANDS,
    requires: Column | str | None = None,
    total: str | None = None,
) -> dict[str, Column]:
    """One 0/1 column per band, plus ``total`` for any value at all."""
    c = F.col(c) if isinstance(c, str) else c
    guard = F.lit(True)
    if requires is not None:
        guard = (F.col(requires) if isinstance(requires, str) else requires).isNotNull()
    flags = {prefix + b.label: F.when(within(c, b) & guard, 1).otherwise(0) for b in bands}
    if total:
        flags[total] = F.when(c.isNotNull() & guard, 1).otherwise(0)
    return flags
