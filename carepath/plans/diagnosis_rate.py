"""Diagnosis rate with control limits over the whole period and each phase."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import pivot_measures
from ..operators.rollup import org_rollup
from ..operators.spc import p_chart, split_phase
from ..sources.tables import Tables, era_union
from .organisations import RATE_LEVELS, RATE_NATIONAL, rebased, type_is

ESTIMATE = "CONDITION_ESTIMATE_65_PLUS"
REGISTER = "CONDITION_REGISTER_65_PLUS"
RATE = "CONDITION_RATE_65_PLUS"
DAY = "Effective_Snapshot_Date"
ORG = ["Org Type", "Org Name", "Org Code", "ICB Name", "Region Name"]

# Fixed value: the month the phases meet; rows dated on it are in neither.
PHASE_SPLIT = date(2020, 3, 1)


def rates(tables: Tables) -> DataFrame:
    """Estimate, register and rate per organisation level and month."""
    columns = ["Org_Type", "Org_Code", "Measure", "Measure_Value", DAY]
    base = era_union(
        tables["diagnosis_rate_old"], tables["diagnosis_rate_new"], columns=columns
    ).withColumn("Measure_Value", F.col("Measure_Value").cast("double"))
    wide = pivot_measures(base, "Measure", "Measure_Value", [ESTIMATE, REGISTER])
    local = rebased(
        wide.where(type_is("Org_Type", "CCG", "SUB_ICB_LOC")),
        "Org_Code",
        tables["ccg_lookup"],
        tables["commissioner_hierarchy"],
    )
    return org_rollup(
        local,
        [DAY],
        [ESTIMATE, REGISTER],
        RATE_LEVELS,
        ratios={RATE: (REGISTER, ESTIMATE)},
        national=wide.where(type_is("Org_Type", "COUNTRY_RESPONSIBILITY")),
        national_level=RATE_NATIONAL,
    )


def diagnosis_rate(
    tables: Tables, split: date = PHASE_SPLIT, closed: str | None = None, clamp: bool = False
) -> DataFrame:
    points = rates(tables)
    full = p_chart(points, ORG, {"2": REGISTER}, ESTIMATE, code="Org Code", clamp=clamp)
    phased = p_chart(
        full, ORG, {"": REGISTER}, ESTIMATE, phase=split_phase(DAY, split, closed), clamp=clamp
    )
    return phased.select(
        *[F.col(f"`{c}`") for c in ORG],
        "pbar", "UCL", "LCL", DAY, ESTIMATE, REGISTER, RATE, "pbar2", "UCL2", "LCL2",
    )
