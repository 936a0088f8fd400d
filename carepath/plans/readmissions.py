"""Emergency readmissions within 30, 60 and 90 days, suppressed."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import is_emergency
from ..functions.disclosure import round_count, suppress
from ..functions.groups import ICB, PROVIDER, SUB_ICB
from ..operators.readmissions import bucket_columns, readmission_pairs
from ..operators.reshape import unpivot_groups
from ..operators.rollup import Geography, geography_sums
from ..operators.weights import reallocate
from ..sources.publish import stamp
from ..sources.staging import stage
from ..sources.tables import Tables
from .admissions import diagnosis_flags, sub_icb_allocation
from .organisations import national, reporting_commissioners, with_commissioner, with_provider

GAP = "TimeBetweenAdmissions"
FLAGS = {"Dem": "Condition", "Age65": "Age65", "Delirium": "Delirium", "MCI": "MCI", "Total": None}
EDGES = (30, 60, 90)
VALUES = [f"Readmissions{e}days" for e in EDGES]

# Published group names, in output order.
GROUPS = {
    "Emergency Admissions - Condition Diagnosis": "Dem",
    "Emergency Admissions - 65+": "Age65",
    "Emergency Admissions - Delirium Diagnosis": "Delirium",
    "Emergency Admissions - MCI Diagnosis": "MCI",
    "Emergency Admissions": "Total",
}

WIDE = [
    Geography(
        PROVIDER,
        "Provider_Code",
        {
            "Organisation_Name": "Provider Name",
            "Region Name": "Provider Region Name",
            "__code": "Provider_Code",
        },
    ),
    national(**{"Organisation_Name": "all", "Region Name": "region", "__code": "all"}),
]
LOCAL = [
    Geography(
        SUB_ICB,
        "SubICB26_Code",
        {
            "Organisation_Name": "SubICB26_Name",
            "Region Name": "Region_Name",
            "__region": "Region_Code",
            "__code": "SubICB26_Code",
        },
    ),
    Geography(
        ICB,
        "ICB_Code",
        {
            "Organisation_Name": "ICB_Name",
            "Region Name": "Region_Name",
            "__region": "Region_Code",
            "__code": "ICB_Code",
        },
    ),
]


def pairs(
    tables: Tables, first_month: date, n_months: int = 12, pick: str = "earliest"
) -> DataFrame:
    """One discharge and the following admission per person and month."""
    spells = (
        tables["spell"]
        .where(is_emergency("Admission_Method"))
        .where(F.col("Patient_Classification") == "1")
        .withColumns(diagnosis_flags("Der_Diagnosis_All", "Age_At_Start_of_Spell_SUS"))
    )
    most_diagnoses_first = F.coalesce(-F.col("Der_Diagnosis_Count"), F.lit(1))
    person = "Der_Pseudo_NHS_Number"
    admissions = spells.select(
        person, "Admission_Date", "APCS_Ident", "Der_Commissioner_Code", "Der_Provider_Code"
    )
    found = readmission_pairs(
        spells.drop("Admission_Date"),
        admissions,
        person,
        "Discharge_Date",
        "Admission_Date",
        first_month,
        n_months,
        pick=pick,
        discharge_order=[F.col("Extract_Date_Time"), most_diagnoses_first, F.col("APCS_Ident")],
        admission_order=[F.col("APCS_Ident")],
        discharge_carry=["Condition", "MCI", "Delirium", "Age65"],
        admission_carry=["Der_Commissioner_Code", "Der_Provider_Code"],
    )
    found = with_commissioner(
        found,
        "Der_Commissioner_Code",
        tables["commissioner_code_changes"],
        reporting_commissioners(tables["commissioner_hierarchy"]),
        {"Sub ICB Code": "Organisation_Code", "Sub ICB Name": "Organisation_Name"},
    )
    return with_provider(
        found,
        "Der_Provider_Code",
        tables["provider_successor"],
        tables["provider_hierarchy"],
        {
            "Provider_Code": "Organisation_Code",
            "Provider Name": "Organisation_Name",
            "Provider Region Name": "Region_Name",
        },
    )


def readmission_counts(
    tables: Tables,
    first_month: date,
    n_months: int = 12,
    pick: str = "earliest",
    splits: DataFrame | None = None,
    staged: bool = False,
) -> DataFrame:
    """Rounded counts, one row per month, organisation and patient group.

    Empty buckets are NULL for Sub-ICBs and ICBs and zero for providers and England.
    """
    base = pairs(tables, first_month, n_months, pick)
    if staged:
        base = stage(base, "readmissions")
    buckets = bucket_columns(GAP, FLAGS, EDGES, empty_as_null=True)
    names, code = list(buckets), "Sub ICB Code"
    # One pass over the pairs serves the wide levels and the shared-out Sub-ICBs.
    finest = base.groupBy("Month", *WIDE[0].columns.values(), code).agg(
        *[c.cast("double").alias(n) for n, c in buckets.items()]
    )
    wide = geography_sums(finest, ["Month"], WIDE, names, "Org_Type").fillna(0.0, names)
    by_code = finest.groupBy("Month", code).agg(*[F.sum(n).alias(n) for n in names])
    allocation = sub_icb_allocation(tables["subicb_2026"], splits)
    local = geography_sums(
        reallocate(by_code, code, allocation, names), ["Month"], LOCAL, names, "Org_Type"
    ).drop("__region")
    long = unpivot_groups(
        wide.unionByName(local).drop("__code"),
        ["Month", "Org_Type", "Organisation_Name", "Region Name"],
        {g: [f"{f} - {v}" for v in VALUES] for g, f in GROUPS.items()},
        VALUES,
        "AdmissionGroup",
    )
    return long.withColumns({v: round_count(v) for v in VALUES})


def readmissions(
    tables: Tables,
    first_month: date,
    run: datetime,
    n_months: int = 12,
    pick: str = "earliest",
    splits: DataFrame | None = None,
    staged: bool = False,
) -> DataFrame:
    counts = readmission_counts(tables, first_month, n_months, pick, splits, staged)
    return stamp(suppress(counts, VALUES), run)
