"""Statistical process control: p-chart limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rollup import ratio


def p_chart(
    points: DataFrame,
    org: Sequence[str],
    numerators: Mapping[str, str],
    denominator: str,
    phase: Column | None = None,
    sigma: float = 3,
    clamp: bool = False,
    code: str | None = None,
) -> DataFrame:
    """Centre line and control limits for each organisation's points.

    ``points`` holds one row per organisation and period, so a chart has as many
    rows as there are periods and fits a window. ``numerators`` maps a column suffix
    to a numerator: '' gives pbar/UCL/LCL, '2' gives pbar2/UCL2/LCL2. With ``phase``
    the limits are fitted within each phase and rows of no phase (NULL) are dropped.
    Limits may pass 0 and 1 unless ``clamp``. Rows with a NULL ``code`` are dropped.
    """
    if code is not None:
        points = points.where(F.col(f"`{code}`").isNotNull())
    keys = [F.col(f"`{c}`") for c in org]
    if phase is not None:
        points = points.withColumn("__phase", phase).where(F.col("__phase").isNotNull())
        keys.append(F.col("__phase"))
    chart = W.partitionBy(*keys)
    n = F.col(f"`{denominator}`").cast("double")

    def total(column: Column) -> Column:
        return F.sum(column.cast("double")).over(chart)

    centres = {
        f"pbar{s}": ratio(total(F.col(f"`{num}`")), total(n)) for s, num in numerators.items()
    }
    out = points.withColumns(centres)
    limits = {}
    for s in numerators:
        p = F.col(f"pbar{s}")
        variance = F.try_divide(p * (F.lit(1.0) - p), n)
        spread = F.when(variance >= 0, F.lit(float(sigma)) * F.sqrt(variance))
        upper, lower = p + spread, p - spread
        limits[f"UCL{s}"] = F.least(upper, F.lit(1.0)) if clamp else upper
        limits[f"LCL{s}"] = F.greatest(lower, F.lit(0.0)) if clamp else lower
    return out.withColumns(limits).drop("__phase")


def split_phase(period: Column | str, cut, closed: str | None = None) -> Column:
    """'before' and 'after' a date; the date itself is in neither unless ``closed``."""
    period = F.col(period) if isinstance(period, str) else period
    before = period <= F.lit(cut) if closed == "before" else period < F.lit(cut)
    after = period >= F.lit(cut) if closed == "after" else period > F.lit(cut)
    return F.when(before, "before").when(after, "after")
