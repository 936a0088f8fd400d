"""Hand-written domain tables."""

from __future__ import annotations

from datetime import date as d
from datetime import datetime as t

from carepath.sources.tables import literal_rows

HIERARCHY = (
    "Organisation_Code string, Organisation_Name string, STP_Code string, STP_Name string, "
    "Region_Code string, Region_Name string, Effective_To date, NHSE_Organisation_Type string"
)
CCG = "Clinical Commissioning Group"


def hierarchy(spark):
    return literal_rows(
        spark,
        [
            ("A1", "Alpha", "X", "ICB X", "R1", "Region One", None, CCG),
            ("A1", "Alpha (old name)", "X", "ICB X", "R1", "Region One", d(2019, 3, 31), CCG),
            ("A2", "Beta", "X", "ICB X", "R1", "Region One", None, CCG),
            ("A3", "Gamma", "Y", "ICB Y", "R2", "Region Two", None, CCG),
            ("H1", "Hub", "Y", "ICB Y", "R2", "Region Two", None, "COMMISSIONING HUB"),
        ],
        HIERARCHY,
    )


def activity_hierarchy(spark):
    """For admissions: rows that must be left out sit beside sound ones."""
    return literal_rows(
        spark,
        [
            ("A1", "Alpha", "X", "ICB X", "R1", "Region One", None, CCG),
            ("D4U1Y", "Frimley", "F", "ICB F", "Y59", "South East", None, CCG),
            ("W1", "Wales", "W", "NonSTP (Wales Region)", "W", "Wales", None, CCG),
            ("E1", "Some Reporting Entity", "X", "ICB X", "R1", "Region One", None, CCG),
            ("N1", "No parent", None, None, "R1", "Region One", None, CCG),
        ],
        HIERARCHY,
    )


def reference(spark):
    pairs = "Main_Code_Text string, Main_Description string, Effective_To date, Valid_From date"
    return {
        "ccg_lookup": literal_rows(
            spark, [("OLD1", "A1"), ("OLD2", "A1"), ("A2", "A2"), ("A3", "A3")],
            "IC_CCG string, CCG21 string",
        ),
        "commissioner_code_changes": literal_rows(
            spark, [("OLD1", "A1"), ("CHAIN1", "CHAIN2"), ("CHAIN2", "A1")],
            "Org_Code string, New_Code string",
        ),
        "provider_successor": literal_rows(
            spark, [("P0", "P1")], "Prov_original string, Prov_successor string"
        ),
        "provider_hierarchy": literal_rows(
            spark,
            [
                ("P1", "Hospital One", "Region One", None),
                ("P2", "Hospital Two", "Region Two", None),
                ("P3", "Closed", "Region Two", d(2018, 1, 1)),
            ],
            "Organisation_Code string, Organisation_Name string, Region_Name string, Effective_To date",
        ),
        "gender": literal_rows(
            spark,
            [("1", "Man (old)", d(2010, 1, 1), None), ("1", "Male", None, None), ("2", "Female", None, None)],
            pairs,
        ),
        "ethnicity": literal_rows(spark, [("A", "British", None, None)], pairs),
        "admission_source": literal_rows(
            spark, [("19", "Home", None, None), ("51", "Hospital", None, d(2015, 1, 1))], pairs
        ),
        "discharge_destination": literal_rows(spark, [("19", "Home", None, None)], pairs),
        "icd10_titles": literal_rows(
            spark,
            [
                ("F03X", "F03", "Unspecified condition", "V", "Mental disorders", None),
                ("R41X", "R41", None, "XVIII", "Symptoms", None),
            ],
            "Alt_Code string, Category_2_Code string, Category_2_Description string, "
            "Chapter_Code string, Chapter_Description string, Effective_To date",
        ),
        "subicb_2026": literal_rows(
            spark,
            [("A1", "Alpha 26", "X", "ICB X", "R1", "LONDON COMMISSIONING REGION")],
            "Sub_ICB_Location_ODS_Code string, Sub_ICB_Location_Name string, ICB_Code string, "
            "Integrated_Care_Board_Name string, Region_Code string, Region_Name string",
        ),
    }


LONG = (
    "Org_Type string, Org_Code string, Measure string, Measure_Value decimal(18,6), "
    "Effective_Snapshot_Date date"
)


def diagnosis_rates(spark):
    from decimal import Decimal

    est, reg = "CONDITION_ESTIMATE_65_PLUS", "CONDITION_REGISTER_65_PLUS"

    def both(kind, code, day, e, r):
        return [
            (kind, code, est, Decimal(e), day),
            (kind, code, reg, Decimal(r), day),
        ]

    feb, mar, apr, may = d(2020, 2, 1), d(2020, 3, 1), d(2020, 4, 1), d(2020, 5, 1)
    old = (
        both("CCG", "OLD1", feb, 100, 60)
        + both("CCG", "OLD2", feb, 100, 70)
        + both("CCG", "A2", feb, 100, 50)
        + both("CCG", "UNKNOWN", feb, 10, 1)
        + both("STP", "X", feb, 9999, 9999)
        + both("COUNTRY_RESPONSIBILITY", "ENG", feb, 1000, 600)
        + both("CCG", "OLD1", mar, 200, 100)
        + both("CCG", "OLD1", apr, 210, 140)
        + [("CCG", "OLD1", "OTHER_MEASURE", Decimal(5), apr)]
        # A repeated measure row: the pivot keeps the larger.
        + [("CCG", "OLD1", reg, Decimal(120), apr)]
    )
    new = both("SUB_ICB_LOC", "OLD1", may, 190, 130) + both("sub_icb_loc", "A3 ", may, 50, 60)
    hidden = literal_rows(spark, old, LONG)
    return {"diagnosis_rate_old": hidden, "diagnosis_rate_new": literal_rows(spark, new, LONG)}


EPISODE = (
    "APCE_Ident string, Admission_Date timestamp_ntz, Discharge_Date timestamp_ntz, Sex string, "
    "Ethnic_Group string, Source_of_Admission string, Discharge_Destination string, "
    "Der_Primary_Diagnosis_Code string, Age_on_Admission int, Der_Diagnosis_All string, "
    "Der_Commissioner_Code string, Der_Provider_Code string, Episode_Number int, "
    "Admission_Method string, Patient_Classification string"
)
SPELL = (
    "APCS_Ident string, Der_Pseudo_NHS_Number string, Admission_Date timestamp_ntz, "
    "Discharge_Date timestamp_ntz, Extract_Date_Time timestamp_ntz, Der_Diagnosis_Count int, "
    "Der_Diagnosis_All string, Age_At_Start_of_Spell_SUS int, Der_Spell_LoS int, "
    "Der_Commissioner_Code string, Der_Provider_Code string, Admission_Method string, "
    "Patient_Classification string"
)


def episode(spark, rows):
    base = dict(
        ident="e", adm=t(2024, 1, 10), dis=t(2024, 1, 20), sex="1", eth="A", src="19", dest="19",
        diag="F03X", age=70, all="||F03X", comm="A1", prov="P1", num=1, method="21", cls="1",
    )
    full = [tuple({**base, "ident": f"e{i}", **r}.values()) for i, r in enumerate(rows)]
    return literal_rows(spark, full, EPISODE)


def spell(spark, rows):
    base = dict(
        ident="s", person="p", adm=t(2024, 1, 10), dis=t(2024, 1, 20), ext=t(2024, 2, 1), n=1,
        all="", age=70, los=1, comm="A1", prov="P1", method="21", cls="1",
    )
    full = [tuple({**base, "ident": f"s{i}", **r}.values()) for i, r in enumerate(rows)]
    return literal_rows(spark, full, SPELL)
