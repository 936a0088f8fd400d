"""Emergency admissions by organisation and patient group, suppressed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import STAY_BANDS, band_label
from ..functions.caseload import flag
from ..functions.codes import (
    DELIRIUM_IN_SPELL,
    CONDITION_IN_SPELL,
    MCI_IN_SPELL,
    flag_codes,
    is_emergency,
)
from ..functions.dates import Window, in_range, month_start
from ..functions.disclosure import suppress
from ..functions.groups import ICB, MISSING, PROVIDER, REGION_SHORT_NAMES, SUB_ICB, TOTAL
from ..functions.labels import code_title, recode
from ..functions.labels import key as text_key
from ..operators.guards import watched
from ..operators.refdata import current
from ..operators.rollup import Geography, geography_sums
from ..operators.weights import allocation_table, reallocate, split_rows
from ..sources.publish import stamp
from ..sources.staging import stage
from ..sources.tables import Tables, era_union
from .organisations import national, reporting_commissioners, with_commissioner, with_provider

# Ordinary, day case, mother and baby.
PATIENT_CLASSES = ["1", "2", "5"]

CHAPTER = "Primary Diagnosis Chapter"
DIAGNOSIS = "Primary Diagnosis"
DESTINATION = "Discharge Destination"
# Category of an episode and the column with its code.
EPISODE_CODES = {
    TOTAL: None,
    "Gender": "Sex",
    "Ethnicity": "Ethnic_Group",
    "Admission Source": "Source_of_Admission",
    DIAGNOSIS: "Der_Primary_Diagnosis_Code",
    DESTINATION: "Discharge_Destination",
}
# What records are summed by, before codes are described.
CODES = ["Month", "Der_Commissioner_Code", "Der_Provider_Code", "Category", "Variable"]

WIDE = [
    Geography(
        PROVIDER,
        "Provider_Code",
        {
            "RegionCode": "Region_Name_Provider",
            "GeographyName": "Provider Name",
            "GeographyCode": "Provider_Code",
        },
    ),
    national(RegionCode="region", GeographyName="all", GeographyCode="all"),
]
LOCAL = [
    Geography(
        SUB_ICB,
        "SubICB26_Code",
        {
            "RegionCode": "Region_Name",
            "GeographyName": "SubICB26_Name",
            "GeographyCode": "SubICB26_Code",
        },
    ),
    Geography(
        ICB,
        "ICB_Code",
        {"RegionCode": "Region_Name", "GeographyName": "ICB_Name", "GeographyCode": "ICB_Code"},
    ),
]

# Published counts and the flag each one sums; None counts every row.
COUNTS = {
    "Emergency Admissions": None,
    "Emergency Admissions - Aged 65 Years and Over": "Age65",
    "Emergency Admissions - Condition Diagnosis": "Condition",
    "Emergency Admissions - Delirium Diagnosis": "Delirium",
    "Emergency Admissions - MCI Diagnosis": "MCI",
}


def diagnosis_flags(text: str, age: str) -> dict:
    return {
        "Condition": flag_codes(text, CONDITION_IN_SPELL),
        "MCI": flag_codes(text, MCI_IN_SPELL),
        "Delirium": flag_codes(text, DELIRIUM_IN_SPELL),
        "Age65": flag(F.col(age) >= 65),
    }


def with_organisations(df: DataFrame, tables: Tables) -> DataFrame:
    df = with_commissioner(
        df,
        "Der_Commissioner_Code",
        tables["commissioner_code_changes"],
        reporting_commissioners(tables["commissioner_hierarchy"]),
        {"Sub ICB Code": "Organisation_Code", "Sub ICB Name": "Organisation_Name"},
        default_when="unmatched",
    )
    return with_provider(
        df,
        "Der_Provider_Code",
        tables["provider_successor"],
        tables["provider_hierarchy"],
        {
            "Provider_Code": "Organisation_Code",
            "Provider Name": "Organisation_Name",
            "Region_Name_Provider": "Region_Name",
        },
    )


def _summed(records: DataFrame) -> DataFrame:
    """Counts per month, raw organisation codes, category and raw value of the category."""
    return records.groupBy(*CODES).agg(
        *[(F.sum(f) if f else F.count("*")).cast("double").alias(n) for n, f in COUNTS.items()]
    )


def episode_sums(tables: Tables, window: Window) -> DataFrame:
    """First episodes of emergency admissions, summed in one pass over the records.

    Every episode gives one row per category, in the month of admission or, for the
    destination, of discharge; months outside the window give none.
    """
    admitted = in_range("Admission_Date", *window)
    discharged = in_range("Discharge_Date", *window)
    in_month = F.when(admitted, month_start("Admission_Date"))
    out_month = F.when(discharged, month_start("Discharge_Date"))
    rows = F.array(
        *[
            F.struct(
                (out_month if category == DESTINATION else in_month).alias("Month"),
                F.lit(category).alias("Category"),
                (F.col(code).cast("string") if code else F.lit(TOTAL)).alias("Variable"),
            )
            for category, code in EPISODE_CODES.items()
        ]
    )
    flags = diagnosis_flags("Der_Diagnosis_All", "Age_on_Admission")
    return _summed(
        tables["episode"]
        .where(admitted | discharged)
        .where(F.col("Episode_Number") == 1)
        .where(is_emergency("Admission_Method"))
        .where(F.col("Patient_Classification").isin(PATIENT_CLASSES))
        .select(
            "Der_Commissioner_Code", "Der_Provider_Code",
            *[c.alias(n) for n, c in flags.items()],
            F.inline(rows),
        )
        .where(F.col("Month").isNotNull())
    )


def spell_sums(tables: Tables, window: Window) -> DataFrame:
    """Emergency spells admitted in the window, summed by length-of-stay band."""
    flags = diagnosis_flags("Der_Diagnosis_All", "Age_At_Start_of_Spell_SUS")
    return _summed(
        tables["spell"]
        .where(in_range("Admission_Date", *window))
        .where(is_emergency("Admission_Method"))
        .where(F.col("Patient_Classification").isin(PATIENT_CLASSES))
        .select(
            "Der_Commissioner_Code", "Der_Provider_Code",
            *[c.alias(n) for n, c in flags.items()],
            month_start("Admission_Date").alias("Month"),
            F.lit("Length of Stay").alias("Category"),
            band_label("Der_Spell_LoS", STAY_BANDS).alias("Variable"),
        )
    )


def admission_sums(tables: Tables, window: Window) -> DataFrame:
    """All counts of the window by raw codes; the months of a window are those of its parts."""
    return episode_sums(tables, window).unionByName(spell_sums(tables, window))


def category_labels(tables: Tables) -> DataFrame:
    """Descriptions of all category codes: __category, __code, __label, __chapter."""
    no_chapter = F.lit(None).cast("string")
    parts = [
        current(tables[name], **({"end": end} if end else {})).select(
            F.lit(category).alias("__category"),
            text_key(F.col("Main_Code_Text")).alias("__code"),
            F.col("Main_Description").alias("__label"),
            no_chapter.alias("__chapter"),
        )
        for category, name, end in (
            ("Gender", "gender", None),
            ("Ethnicity", "ethnicity", None),
            ("Admission Source", "admission_source", ["Effective_To", "Valid_From"]),
            (DESTINATION, "discharge_destination", None),
        )
    ]
    parts.append(
        current(tables["icd10_titles"]).select(
            F.lit(DIAGNOSIS).alias("__category"),
            text_key(F.col("Alt_Code")).alias("__code"),
            code_title("Category_2_Code", "Category_2_Description").alias("__label"),
            code_title("Chapter_Code", "Chapter_Description").alias("__chapter"),
        )
    )
    return era_union(*parts)


def described(sums: DataFrame, tables: Tables) -> DataFrame:
    """Sums with the descriptions of their codes and present organisations.

    A reference key that repeats multiplies sums just as it would have multiplied records.
    """
    category = F.col("Category")
    labels = watched(category_labels(tables), ["__category", "__code"], "category codes")
    joined = sums.join(
        labels,
        (category == F.col("__category")) & (text_key(F.col("Variable")) == F.col("__code")),
        "left",
    )
    label = (
        F.when(category.isin(TOTAL, "Length of Stay"), F.col("Variable"))
        .when(category == DIAGNOSIS, F.col("__label"))
        .otherwise(F.coalesce("__label", F.lit(MISSING)))
    )
    named = joined.withColumns({"Variable": label, CHAPTER: F.col("__chapter")}).drop(
        "__category", "__code", "__label", "__chapter"
    )
    return with_organisations(named, tables)


def sub_icb_allocation(sub_icbs: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Present Sub-ICBs at weight 1, and those that were split."""
    present = sub_icbs.select(
        F.col("Sub_ICB_Location_ODS_Code").alias("SubICB_Code"),
        F.col("Sub_ICB_Location_Name").alias("SubICB_Name"),
        F.col("Sub_ICB_Location_ODS_Code").alias("SubICB26_Code"),
        F.col("Sub_ICB_Location_Name").alias("SubICB26_Name"),
        "ICB_Code",
        F.col("Integrated_Care_Board_Name").alias("ICB_Name"),
        "Region_Code",
        recode("Region_Name", REGION_SHORT_NAMES).alias("Region_Name"),
    )
    return allocation_table(present, split_rows(sub_icbs.sparkSession) if splits is None else splits)


def admissions_counts(
    tables: Tables, window: Window, splits: DataFrame | None = None, staged: bool = False,
    sums: DataFrame | None = None,
) -> DataFrame:
    """Unsuppressed counts; discharge rows are by month of discharge, others of admission.

    Records are summed by raw codes before any reference table is joined. The wide levels and
    the shared-out Sub-ICBs are both made from the described sums. ``sums`` are those of
    ``admission_sums``, if they are stored: no record is read then.
    """
    names, code = list(COUNTS), "Sub ICB Code"
    labels = ["Month", "Category", "Variable", CHAPTER]
    sums = admission_sums(tables, window) if sums is None else sums
    finest = (
        described(sums, tables)
        .groupBy(*labels, *[F.col(f"`{c}`") for c in WIDE[0].columns.values()], code)
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    if staged:
        finest = stage(finest, "admission-sums")
    wide = geography_sums(finest, labels, WIDE, names, "GroupType")
    by_code = finest.groupBy(*labels, code).agg(*[F.sum(n).alias(n) for n in names])
    allocation = sub_icb_allocation(tables["subicb_2026"], splits)
    local = geography_sums(
        reallocate(by_code, code, allocation, names), labels, LOCAL, names, "GroupType"
    )
    return wide.unionByName(local)


def admissions(
    tables: Tables,
    window: Window,
    run: datetime,
    splits: DataFrame | None = None,
    digits: int | None = 0,
    staged: bool = False,
    sums: DataFrame | None = None,
) -> DataFrame:
    counts = admissions_counts(tables, window, splits, staged, sums)
    shown = suppress(counts, list(COUNTS), digits=digits)
    return stamp(
        shown.select(
            "Month", "GroupType", "RegionCode", "GeographyName", "Category", "Variable",
            *[F.col(f"`{c}`") for c in COUNTS], CHAPTER,
        ),
        run,
    )
