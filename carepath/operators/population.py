"""Population denominators and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rollup import Category, Geography, labelled_grouping_sets, ratio


def population(
    base: DataFrame,
    variable: Column,
    category: str,
    levels: Sequence[Geography],
    count: str = "Count",
    whole_numbers: bool = False,
) -> DataFrame:
    """Population of each group of one category at every organisation level."""
    banded = base.withColumn("__variable", variable)
    out = labelled_grouping_sets(
        banded,
        [],
        levels,
        [Category(category, "__variable")],
        {"Pop": F.sum(count)},
        level="Org_Type",
        additive=True,
    )
    total = F.col("Pop")
    return out.withColumn("Pop", (F.round(total, 0) if whole_numbers else total).cast("double"))


def rate(
    counts: DataFrame,
    denominators: DataFrame,
    on: Sequence[str],
    count: str,
    pop: str = "Pop",
    per: int = 100_000,
    out: str = "Rate",
    how: str = "left",
) -> DataFrame:
    """Counts per head of population.

    A count whose group has no population stays, with a NULL rate. ``how="full"`` also
    keeps populations without a count, as a count of 0.
    """
    joined = counts.join(denominators.select(*on, pop), list(on), how)
    if how == "full":
        joined = joined.withColumn(count, F.coalesce(count, F.lit(0)))
    return joined.withColumn(out, ratio(F.col(count) * F.lit(float(per)), pop))
