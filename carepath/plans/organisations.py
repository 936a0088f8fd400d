"""Organisation look-ups shared by the jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.groups import (
    ALL_REGIONS,
    ENGLAND,
    ICB,
    NATIONAL,
    OTHER,
    REGION,
    SUB_ICB,
)
from ..functions.labels import key
from ..operators.refdata import attach, current, resolve_code
from ..operators.rollup import Geography

# Hierarchy rows that are not reporting organisations.
COMMISSIONER_TYPE = "CLINICAL COMMISSIONING GROUP"
NOT_AN_ORGANISATION = "REPORTING ENTITY"
OUTSIDE_ENGLAND = "NonSTP (Wales Region)"


def current_sub_icbs(hierarchy: DataFrame) -> DataFrame:
    """Sub-ICBs in force, with their ICB and region."""
    return (
        current(hierarchy)
        .where(key("NHSE_Organisation_Type") == COMMISSIONER_TYPE)
        .select(
            F.col("Organisation_Code").alias("Sub ICB Code"),
            F.col("Organisation_Name").alias("Sub ICB Name"),
            F.col("STP_Code").alias("ICB Code"),
            F.col("STP_Name").alias("ICB Name"),
            F.col("Region_Code").alias("Region Code"),
            F.col("Region_Name").alias("Region Name"),
        )
        .distinct()
    )


def rebased(facts: DataFrame, code: str, ccg_lookup: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Facts under their present Sub-ICB, found through the code look-up."""
    orgs = current_sub_icbs(hierarchy)
    mapped = attach(facts, code, ccg_lookup, "IC_CCG", {"__present": "CCG21"}, collated=True)
    return attach(
        mapped, "__present", orgs, "Sub ICB Code", {c: c for c in orgs.columns}, collated=True
    ).drop("__present")


# Levels of the two rate dashboards; names are those of the published tables.
RATE_LEVELS = [
    Geography(
        SUB_ICB,
        "Sub ICB Code",
        {"Org Name": "Sub ICB Name", "Org Code": "Sub ICB Code", "ICB Name": "ICB Name"},
        {"Region Name": None},
    ),
    Geography(
        ICB,
        "ICB Code",
        {
            "Org Name": "ICB Name",
            "Org Code": "ICB Code",
            "ICB Name": "ICB Name",
            "Region Name": "Region Name",
        },
    ),
    Geography(
        REGION,
        "Region Code",
        {"Org Name": "Region Name", "Org Code": "Region Code", "Region Name": "Region Name"},
        {"ICB Name": None},
    ),
]
RATE_NATIONAL = Geography(NATIONAL, None, {}, {"Org Name": ENGLAND, "Org Code": ENGLAND})


def reporting_commissioners(hierarchy: DataFrame) -> DataFrame:
    """Commissioners without reporting entities and without those outside England.

    An organisation with no parent name fails the second test, as NULL does in SQL.
    """
    return hierarchy.where(
        ~F.upper("Organisation_Name").contains(NOT_AN_ORGANISATION)
        & (key("STP_Name") != F.upper(F.lit(OUTSIDE_ENGLAND)))
    )


def with_commissioner(
    df: DataFrame,
    code: str,
    changes: DataFrame,
    hierarchy: DataFrame,
    columns: Mapping[str, str],
    default_when: str = "null",
) -> DataFrame:
    df = resolve_code(df, code, changes, "Org_Code", "New_Code", "__commissioner", collated=True)
    return attach(
        df, "__commissioner", hierarchy, "Organisation_Code", columns, OTHER, default_when,
        collated=True,
    ).drop("__commissioner")


def with_provider(
    df: DataFrame,
    code: str,
    successors: DataFrame,
    hierarchy: DataFrame,
    columns: Mapping[str, str],
) -> DataFrame:
    df = resolve_code(
        df, code, successors, "Prov_original", "Prov_successor", "__provider", collated=True
    )
    return attach(
        df, "__provider", current(hierarchy), "Organisation_Code", columns, OTHER, collated=True
    ).drop("__provider")


def national(**columns: str) -> Geography:
    """The level of everything; outputs named by keyword, 'region' the only non-England one."""
    return Geography(
        NATIONAL, None, {}, {c: ALL_REGIONS if v == "region" else ENGLAND for c, v in columns.items()}
    )


def type_is(c: str, *values: str) -> Column:
    return key(c).isin([v.upper() for v in values])
