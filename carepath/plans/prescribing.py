"""Prescribing proportions: two measures over one register, with control limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rollup import org_rollup
from ..operators.spc import p_chart
from ..sources.tables import Tables, era_union
from .diagnosis_rate import DAY, ORG
from .organisations import RATE_LEVELS, RATE_NATIONAL, rebased, type_is

WITHOUT = "ANTI_PSY_NO_PSY_DIAG_ALL_AGES"
WITH = "ANTI_PSY_PSY_DIAG_ALL_AGES"
REGISTER = "DEM_REGISTER"
SHARE_WITHOUT = "Proportion_of_DEM_WITH_ANTI_PSY_AND_NO_PSY_DIAG"
SHARE_WITH = "Proportion_of_DEM_WITH_ANTI_PSY_AND_PSY_DIAG"
SOURCE = {
    "Without Psychosis Diagnosis": WITHOUT,
    "With Psychosis Diagnosis": WITH,
    "Condition Register": REGISTER,
}


def proportions(tables: Tables) -> DataFrame:
    """Counts and proportions per organisation level and month."""
    base = era_union(
        tables["antipsychotic_old"],
        tables["antipsychotic_new"],
        columns=["Month", "Type", "Code", *[f"`{c}`" for c in SOURCE]],
    ).select(
        F.col("Month").cast("date").alias(DAY),
        "Type",
        "Code",
        *[F.col(f"`{src}`").cast("double").alias(out) for src, out in SOURCE.items()],
    )
    local = rebased(
        base.where(type_is("Type", "CCG", "SUB_ICB_LOC")),
        "Code",
        tables["ccg_lookup"],
        tables["commissioner_hierarchy"],
    )
    return org_rollup(
        local,
        [DAY],
        [WITHOUT, WITH, REGISTER],
        RATE_LEVELS,
        ratios={SHARE_WITH: (WITH, REGISTER), SHARE_WITHOUT: (WITHOUT, REGISTER)},
        national=base.where(type_is("Type", "National")),
        national_level=RATE_NATIONAL,
    )


def prescribing(tables: Tables, keep_unmatched: bool = True, clamp: bool = False) -> DataFrame:
    """Control chart of both proportions.

    Organisations without a present code have no place on the chart. Each such group
    stays as one row that carries its centre lines and no months, unless
    ``keep_unmatched`` is off.
    """
    chart = p_chart(
        proportions(tables),
        ORG,
        {"": WITHOUT, "2": WITH},
        REGISTER,
        code=None if keep_unmatched else "Org Code",
        clamp=clamp,
    )
    detail = ["UCL", "LCL", "UCL2", "LCL2", DAY, WITHOUT, WITH, REGISTER, SHARE_WITH, SHARE_WITHOUT]
    chart = chart.select(*[F.col(f"`{c}`") for c in ORG], "pbar", "pbar2", *detail)
    if not keep_unmatched:
        return chart
    placed = F.col("`Org Code`").isNotNull()
    blank = chart.where(~placed).withColumns(
        {c: F.lit(None).cast(chart.schema[c].dataType) for c in detail}
    )
    return chart.where(placed).unionByName(blank.distinct())
