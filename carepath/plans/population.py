"""Small-area look-up, population denominators and rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.groups import (
    AREA_RECODES,
    CENSUS_AGE,
    CENSUS_ETHNIC_MEASURES,
    CENSUS_ETHNIC_PATTERNS,
    CENSUS_SEX,
    ENGLAND,
    ETHNIC_DEFAULT,
    GENDER_DEFAULT,
    ICB,
    NATIONAL,
    SUB_ICB,
)
from ..functions.labels import group_codes, group_text, recode, recode_or_keep
from ..operators.events import first_row
from ..operators.population import population, rate
from ..operators.refdata import attach
from ..operators.rollup import Geography
from ..sources.staging import stage
from ..sources.tables import Tables

# Fixed value: the census day.
CENSUS_DAY = date(2021, 3, 21)

LEVELS = [
    Geography(SUB_ICB, "SubICBCode", {"Org_Name": "SubICBName", "Org_Code": "SubICBCode"}),
    Geography(ICB, "ICBCode", {"Org_Name": "ICBName", "Org_Code": "ICBCode"}),
    Geography(NATIONAL, None, {}, {"Org_Name": ENGLAND, "Org_Code": ENGLAND}),
]
AREA = ["SubICBCode", "ICBCode", "ICBName", "Region_Code", "Region_Name"]


def area_lookup(tables: Tables) -> DataFrame:
    """English small areas with their Sub-ICB, ICB and region."""
    names = tables["ccg_names_scd"]
    short = {old: code for old, (_, code) in AREA_RECODES.items()}
    renamed = names.select(
        recode_or_keep("CCG_Code2", {old: new for old, (new, _) in AREA_RECODES.items()}).alias(
            "ONS_SubICB_Code22"
        ),
        recode("CCG_Code2", short, otherwise=F.col("CCG_Code")).alias("ODS_SubICB_Code22"),
    ).distinct()
    areas = tables["postcode_lookup"].select("lsoa21", "msoa21", "ccg").where(
        F.col("lsoa21").startswith("E")
    )
    # One row per area, not per postcode, before the joins.
    areas = areas.distinct()
    areas = attach(
        areas,
        "ccg",
        renamed,
        "ONS_SubICB_Code22",
        {c: c for c in renamed.columns},
        collated=True,
    )
    return (
        attach(
            areas,
            "ODS_SubICB_Code22",
            tables["commissioner_hierarchy"],
            "Organisation_Code",
            {
                "SubICBCode": "Organisation_Code",
                "SubICBName": "Organisation_Name",
                "ICBCode": "STP_Code",
                "ICBName": "STP_Name",
                "Region_Code": "Region_Code",
                "Region_Name": "Region_Name",
            },
            collated=True,
        )
        .drop("ccg")
        .withColumnsRenamed({"lsoa21": "LSOA21", "msoa21": "MSOA21"})
        .distinct()
    )


def _census_base(
    facts: DataFrame, lookup: DataFrame, area: str, hierarchy: DataFrame, assign: str
) -> DataFrame:
    """Census counts by organisation; an area that lies in two counts in both.

    The look-up is brought down to the census area before the join, so small areas
    do not multiply the counts only to be removed again.
    """
    codes = lookup.select(
        F.col(area).alias("Geography_Code"),
        F.col("ODS_SubICB_Code22").alias("SubICBCode"),
        *AREA[1:],
    ).distinct()
    if assign == "first":
        codes = first_row(codes, ["Geography_Code"], [F.col("SubICBCode")], AREA)
    joined = facts.distinct().join(codes, "Geography_Code", "inner")
    named = attach(
        joined,
        "SubICBCode",
        hierarchy,
        "Organisation_Code",
        {"SubICBName": "Organisation_Name"},
        collated=True,
    )
    return named.distinct()


def population_table(
    tables: Tables, day: date = CENSUS_DAY, assign: str = "all", staged: bool = False
) -> DataFrame:
    """Population by age, gender and ethnicity for Sub-ICBs, ICBs and England.

    ``staged`` writes the look-up once where it is not a table already; all three
    breakdowns read it.
    """
    lookup, hierarchy = tables["area_lookup"], tables["commissioner_hierarchy"]
    if staged:
        lookup = stage(lookup, "area-lookup")
    on_day = F.col("Effective_Snapshot_Date").cast("date") == F.lit(day)
    area_type = F.lower("Geography_Type")
    age = (
        tables["census_age"]
        .where(on_day & (area_type == "msoa") & F.col("Geography_Code").startswith("E"))
        .where(F.col("Measure_Name").isin([m for ms in CENSUS_AGE.values() for m in ms]))
        .select("Geography_Code", "Measure_Name", "Count")
    )
    sex = (
        tables["census_sex"]
        .where(on_day & F.col("Geography_Code").startswith("E01"))
        .where(F.col("Sex") != "All persons")
        .select("Geography_Code", "Sex", "Count")
    )
    ethnicity = (
        tables["census_ethnicity"]
        .where(on_day & (area_type == "lsoa") & F.col("Geography_Code").startswith("E01"))
        .where(F.col("Measure").isin(CENSUS_ETHNIC_MEASURES))
        .select("Geography_Code", "Measure", F.col("Measure_Value").alias("Count"))
    )
    parts = [
        population(
            _census_base(age, lookup, "MSOA21", hierarchy, assign),
            group_codes("Measure_Name", CENSUS_AGE, None),
            "Age Group",
            LEVELS,
        ),
        population(
            _census_base(sex, lookup, "LSOA21", hierarchy, assign),
            group_codes("Sex", CENSUS_SEX, GENDER_DEFAULT),
            "Gender",
            LEVELS,
        ),
        population(
            _census_base(ethnicity, lookup, "LSOA21", hierarchy, assign),
            group_text("Measure", CENSUS_ETHNIC_PATTERNS, ETHNIC_DEFAULT),
            "Ethnicity",
            LEVELS,
            whole_numbers=True,
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def open_referral_rates(metrics: DataFrame, populations: DataFrame) -> DataFrame:
    """Open referrals per 100,000 of each group, by month and organisation."""
    counts = metrics.groupBy("Month", "Orgtype", "OrgCode", "Category", "Variable").agg(
        F.sum("OpenReferrals").alias("OpenReferrals")
    )
    pops = populations.select(
        F.col("Org_Type").alias("Orgtype"),
        F.col("Org_Code").alias("OrgCode"),
        "Category",
        "Variable",
        "Pop",
    )
    return rate(
        counts, pops, ["Orgtype", "OrgCode", "Category", "Variable"], "OpenReferrals",
        out="OpenReferralsPer100k",
    )
