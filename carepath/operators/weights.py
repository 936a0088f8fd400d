"""Population-weighted reallocation of organisations that were split or merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.groups import OTHER, SPLIT_COLUMNS, SPLIT_ROWS
from ..sources.tables import literal_rows

WEIGHT = "PopWeight"
TARGETS = ["SubICB26_Code", "SubICB26_Name", "ICB_Code", "ICB_Name", "Region_Code", "Region_Name"]


def split_rows(spark, rows: Sequence[tuple] = SPLIT_ROWS) -> DataFrame:
    schema = ", ".join(f"{c} {'double' if c == WEIGHT else 'string'}" for c in SPLIT_COLUMNS)
    return literal_rows(spark, rows, schema)


def allocation_table(current: DataFrame, splits: DataFrame) -> DataFrame:
    """Present organisations mapped to themselves with weight 1, and the split rows."""
    return current.withColumn(WEIGHT, F.lit(1.0)).unionByName(splits)


def reallocate(
    counts: DataFrame,
    code: str,
    allocation: DataFrame,
    measures: Sequence[str],
    key: str = "SubICB_Code",
    targets: Mapping[str, str] | Sequence[str] = TARGETS,
    weight: str = WEIGHT,
    default: str | None = OTHER,
) -> DataFrame:
    """Counts shared out over successor organisations.

    ``counts`` is aggregated already: a count times its weight equals the sum of
    the weights, and the fan-out to several successors then multiplies a few
    groups, not the records. Codes without a row keep weight 1 and go to ``default``.
    """
    named = targets if isinstance(targets, Mapping) else {t: t for t in targets}
    right = allocation.select(
        F.col(key).alias("__code"),
        F.col(weight).alias("__weight"),
        *[F.col(src).alias(f"__to_{i}") for i, src in enumerate(named.values())],
    )
    w = F.coalesce("__weight", F.lit(1.0))
    to = {out: F.col(f"__to_{i}") for i, out in enumerate(named)}
    if default is not None:
        to = {out: F.coalesce(c, F.lit(default)) for out, c in to.items()}
    return (
        counts.join(right, F.col(code) == F.col("__code"), "left")
        .withColumns({**to, **{m: F.col(m) * w for m in measures}, weight: w})
        .drop("__code", "__weight", *[f"__to_{i}" for i in range(len(named))])
    )
