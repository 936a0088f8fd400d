"""Referral pathway and population on hand-written tables."""

import os
from datetime import date as d
from datetime import datetime as t

import pytest
from domain import HIERARCHY, hierarchy, reference
from pyspark.sql import functions as F

from carepath.functions.dates import Window
from carepath.plans.population import area_lookup, open_referral_rates, population_table
from carepath.plans.referral_pathway import (
    bucketed_base,
    diagnosis_cohort,
    first_contacts,
    main_metrics,
    metric_sums,
    pathway_outputs,
    ranked_diagnoses,
    referral_base,
    wait_times,
)
from carepath.sources.tables import literal_rows

RUN = t(2024, 6, 1, 9, 0)
PRIMARY = "Der_Person_ID string, UniqServReqID string, PrimDiag string, CodedDiagTimestamp timestamp_ntz"


def tables(spark):
    may, jun = t(2021, 5, 10), t(2021, 6, 10)
    primary = [
        ("d1", "r1", "F067", may),
        ("d1", "r1", "F000", may),
        ("d1", "r1", "F03X", jun),
        ("d1", "r1", "F000", jun),
        ("d1", "r1", "F03X", jun),
        ("d2", "r2", "E00..1", may),
        ("d3", "r3", "F067", t(2021, 1, 5)),
        ("d4", "r4", "Z99", may),
    ]
    secondary = [("d1", "r1", "F001", may), ("d2", "r2", "F001", may)]
    referral = (
        "RecordNumber long, UniqServReqID string, Person_ID string, Der_Person_ID string, "
        "NHSEUniqSubmissionID string, OrgIDComm string, OrgIDProv string, "
        "ReferralRequestReceivedDate date, ServDischDate date, UniqMonthID int, "
        "AgeServReferRecDate int, PrimReasonReferralMH string"
    )
    rows = [
        # Before April 2021 the derived person id is the key.
        (10, "r1", "x1", "d1", "s03", "OLD1", "P0", d(2021, 3, 2), None, 1452, 70, "05"),
        (11, "r1", "d1", "d1", "s05", "OLD1", "P0", d(2021, 3, 2), None, 1454, 70, "05"),
        (12, "r1", "d1", "d1", "s06", "A1", "P1", d(2021, 3, 2), d(2021, 6, 30), 1455, 70, "05"),
        (13, "r2", "d2", "d2", "s05", "ZZ", "P3", d(2021, 5, 1), d(2021, 5, 31), 1454, None, "99"),
        (14, "r3", "d3", "d3", "s05", "A2", "P2", d(2021, 5, 31), d(2021, 7, 1), 1454, 85, "05"),
        (15, "r5", "d5", "d5", "s05", "A2", "P2", d(2020, 5, 31), None, 1454, 64, "05"),
        # A superseded submission and a month outside the window.
        (16, "r2", "d2", "d2", "s05old", "A2", "P2", d(2021, 5, 1), None, 1454, 60, "05"),
        (17, "r2", "d2", "d2", "s09", "A2", "P2", d(2021, 5, 1), None, 1458, 60, "05"),
    ]
    contacts = [
        ("r1", "d1", d(2021, 4, 13), "5", "01"),
        ("r1", "d1", d(2021, 3, 10), "7", "01"),
        ("r1", "d1", d(2021, 3, 11), "5", "99"),
        ("r1", "x1", d(2021, 3, 3), "5", "01"),
        ("r3", "d3", d(2021, 5, 30), "6", "11"),
    ]
    latest = "Main_Code_Text string, Main_Description string, Is_Latest int"
    return {
        **reference(spark),
        "commissioner_hierarchy": hierarchy(spark),
        "primary_diagnosis": literal_rows(spark, primary, PRIMARY),
        "secondary_diagnosis": literal_rows(spark, secondary, PRIMARY.replace("PrimDiag", "SecDiag")),
        "referral": literal_rows(spark, rows, referral),
        "patient_index": literal_rows(
            spark,
            [(10, "A", "1"), (11, "A", "1"), (12, "A", "1"), (13, "Z", None), (14, "H", "2"),
             (15, "S", "9"), (16, "A", "1"), (17, "A", "1")],
            "RecordNumber long, EthnicCategory string, Gender string",
        ),
        "care_plan": literal_rows(
            spark,
            [(11, d(2021, 5, 2)), (11, d(2021, 5, 3)), (11, d(2021, 6, 9)), (12, d(2021, 5, 2)),
             (14, d(2021, 5, 31)), (14, d(2021, 5, 1))],
            "RecordNumber long, CarePlanCreatDate date",
        ),
        "service_type": literal_rows(
            spark,
            [("r1", 10, "d1", "A18"), ("r1", 11, "d1", "A18"), ("r1", 12, "d1", "A18"),
             ("r2", 13, "d2", "A18"), ("r3", 14, "d3", "XX"), ("r2", 17, "d2", "A18")],
            "UniqServReqID string, RecordNumber long, Der_Person_ID string, ServTeamTypeRefToMH string",
        ),
        "submission_flags": literal_rows(
            spark,
            [("s03", "Y", d(2021, 3, 1), d(2021, 3, 31)), ("s05", "Y", d(2021, 5, 1), d(2021, 5, 31)),
             ("s06", "Y", d(2021, 6, 1), d(2021, 6, 30)), ("s05old", "N", d(2021, 5, 1), d(2021, 5, 31)),
             ("s09", "Y", d(2021, 9, 1), d(2021, 9, 30))],
            "NHSEUniqSubmissionID string, Der_IsLatest string, ReportingPeriodStartDate date, "
            "ReportingPeriodEndDate date",
        ),
        "care_contact": literal_rows(
            spark, contacts,
            "UniqServReqID string, Der_Person_ID string, CareContDate date, "
            "AttendOrDNACode string, ConsMechanismMH string",
        ),
        "team_type": literal_rows(
            spark, [("A18", "Memory clinic", 0), ("A18", "Memory Services/Clinic/Drop In Service", 1)], latest
        ),
        "referral_reason": literal_rows(spark, [("05", "Organic brain disorder", 1)], latest),
    }


MONTHS = Window(d(2021, 3, 1), d(2021, 6, 1))


def test_cohort_and_ranks(spark):
    src = tables(spark)
    plain = diagnosis_cohort(src)
    assert {(r.UniqServReqID, r.DiagnosisCode, r.Position) for r in plain.collect()} == {
        ("r1", "F067", "Primary"), ("r1", "F000", "Primary"), ("r1", "F03X", "Primary"),
        ("r3", "F067", "Primary"),
    }
    assert plain.count() == 5
    both = diagnosis_cohort(src, include_secondary_only=True).where("Position = 'Secondary'").collect()
    assert [(r.UniqServReqID, r.DiagnosisCode) for r in both] == [("r2", "F001")]
    wild = diagnosis_cohort(src, wildcards=True).where("UniqServReqID = 'r2'").collect()
    assert [r.DiagnosisCode for r in wild] == ["E00..1"]
    ranked = {r.UniqServReqID: r for r in ranked_diagnoses(plain).collect()}
    assert ranked["r1"].EarliestDiagnosisArea == "MCI"
    assert ranked["r1"].LatestDiagnosisArea == "Condition"
    assert ranked["r1"].LatestCodedDiagTimestamp == t(2021, 6, 10)
    late = literal_rows(spark, [("d9", "r9", "F000", t(2021, 7, 1, 23, 30))], PRIMARY)
    moved = diagnosis_cohort({**src, "primary_diagnosis": late}, tz="Europe/London").first()
    assert moved.CodedDiagTimestamp == t(2021, 7, 2, 0, 30)


def test_first_contacts(spark):
    got = {(r[0], r[1]): r[2] for r in first_contacts(tables(spark)["care_contact"]).collect()}
    assert got == {
        ("r1", "d1"): d(2021, 4, 13), ("r1", "x1"): d(2021, 3, 3), ("r3", "d3"): d(2021, 5, 30),
    }


def test_base_waits_and_metrics(spark):
    src = tables(spark)
    base = referral_base(src, MONTHS)
    rows = base.collect()
    got = {(r.UniqServReqID, r.Month, r.RefwithCarePlanCreated): r for r in rows}
    assert len(got) == len(rows) == 7
    march = got["r1", d(2021, 3, 1), 0]
    assert march.FirstContactDate == d(2021, 4, 13)  # joined on the derived id
    assert march.WaitRefContact is None and march.Refwaiting1stcontact == 1 and march.NewRef == 1
    assert (march.OrgIDComm, march.OrgIDProv) == ("A1", "P1")
    # Care plans on both sides of the period end: one row for each flag.
    may1, may0 = got["r1", d(2021, 5, 1), 1], got["r1", d(2021, 5, 1), 0]
    assert may1.WaitRefContact == 42 and may0.WaitRefDiag == 69
    assert (may1.EarliestDiagnosisArea, may1.LatestDiagnosisArea) == ("MCI", "Condition")
    assert may1.EarliestDiagDateMonthFlag == 1 and may1.RefToEarliestDiagOrder == "Diagnosis After Referral"
    june = got["r1", d(2021, 6, 1), 0]
    assert (june.OpenRef, june.DischRef, june.FirstContactDateMonthFlag) == (0, 1, 0)
    other = got["r2", d(2021, 5, 1), 0]
    assert (other.Sub_ICB_Name, other.Provider_Name, other.PrimReason) == ("Other", "Other", "Missing/invalid")
    assert other.RefToEarliestDiagOrder == "No Diagnosis" and other.DischRef == 1
    before = got["r3", d(2021, 5, 1), 1]
    assert before.WaitRefContact is None and before.FirstContactDateMonthFlag == 1
    assert before.RefToEarliestDiagOrder == "Diagnosis Before Referral" and before.WaitRefDiag is None
    assert before.TeamType == "Missing/invalid" and before.OpenRef == 1
    no_team = got["r5", d(2021, 5, 1), 0]
    assert no_team.ServTeamTypeRefToMH is None and no_team.LatestDiagnosisArea is None
    assert referral_base(src, MONTHS, one_row_per_referral=True).count() == 6
    # A period without an end: every referral stays, without a care plan.
    flags = src["submission_flags"].withColumn("ReportingPeriodEndDate", F.lit(None).cast("date"))
    endless = referral_base({**src, "submission_flags": flags}, MONTHS).collect()
    assert {r.RefwithCarePlanCreated for r in endless} == {0}
    assert {(r.UniqServReqID, r.Month) for r in endless} == {(r.UniqServReqID, r.Month) for r in rows}

    waits = {(r.Month, r.RefwithCarePlanCreated): r for r in wait_times(base, RUN).collect()}
    assert set(waits) == {(d(2021, 3, 1), 0), (d(2021, 5, 1), 0), (d(2021, 5, 1), 1), (d(2021, 6, 1), 0)}
    w = waits[d(2021, 5, 1), 1]
    assert (w.ContactUnder6weeksNumber, w.Contact6to18weeksNumber, w.TotalReferralsWithContact) == (1, 0, 1)
    assert (w.DiagUnder6weeksNumber, w.Diag6to18weeksNumber, w.DiagOver18weeksNumber) == (0, 1, 0)
    assert w.ConditionDiagnosis == "1" and w.DataSubmissionType == "R" and w.SnapshotDate == RUN
    assert waits[d(2021, 3, 1), 0].TotalReferralsWithContact == 0

    metrics = main_metrics(base, RUN)
    m = metrics.groupBy("Month", "Orgtype", "OrgCode", "Region", "Category", "Variable").agg(
        *[F.sum(c).alias(c) for c in ("NewReferrals", "OpenReferrals", "Discharges", "OpenWaitingFirstCont")]
    )
    m = {(r.Month, r.Orgtype, r.OrgCode, r.Category, r.Variable): r for r in m.collect()}
    may = d(2021, 5, 1)
    whole = m[may, "National", "England", "Total", "Total"]
    assert (whole.NewReferrals, whole.OpenReferrals, whole.Discharges, whole.Region) == (2, 4, 1, "All Regions")
    assert m[may, "ICB", "X", "Total", "Total"].OpenReferrals == 4
    assert m[may, "Sub-ICB", "A1", "Gender", "Males"].OpenReferrals == 2
    assert m[may, "Provider", "Other", "Age Group", "Unknown/Not Stated"].Discharges == 1
    assert m[may, "National", "England", "Age Group", "85+"].NewReferrals == 1
    assert m[may, "National", "England", "Ethnicity", "Not Stated/Not Known"].NewReferrals == 1
    assert m[may, "Sub-ICB", "A2", "Ethnicity", "Other"].OpenWaitingFirstCont == 1
    detail = metrics.where("Orgtype = 'National' AND Category = 'Total' AND ConditionDiagnosis = 1")
    assert {r["Condition Diagnosis Code"] for r in detail.collect()} == {"F03X", "F067"}


def test_population_and_rates(spark):
    census = d(2021, 3, 21)
    names = literal_rows(
        spark, [("99E", "E38000220"), ("A2", "E2"), ("A2", "E2")], "CCG_Code string, CCG_Code2 string"
    )
    postcode = literal_rows(
        spark,
        [("E01000001", "E02000001", "E38000258"), ("E01000001", "E02000001", "E38000258"),
         ("E01000002", "E02000001", "E2"), ("E01000003", "E02000003", "E2"), ("W01000001", "W02", "E2"),
         ("E01000009", "E02000009", "E-none")],
        "lsoa21 string, msoa21 string, ccg string",
    )
    orgs = literal_rows(
        spark,
        [("15E", "Birmingham", "X", "ICB X", "R1", "Region One", None, "c"),
         ("A2", "Beta", "X", "ICB X", "R1", "Region One", None, "c")],
        HIERARCHY,
    )
    lookup = area_lookup({"ccg_names_scd": names, "postcode_lookup": postcode, "commissioner_hierarchy": orgs})
    rows = {r.LSOA21: r for r in lookup.collect()}
    assert set(rows) == {"E01000001", "E01000002", "E01000003", "E01000009"} and lookup.count() == 4
    assert (rows["E01000001"].ODS_SubICB_Code22, rows["E01000001"].SubICBName) == ("15E", "Birmingham")
    assert rows["E01000009"].ICBCode is None

    age_schema = (
        "Geography_Code string, Geography_Type string, Measure_Name string, Count long, "
        "Effective_Snapshot_Date date"
    )
    age = [
        ("E02000001", "msoa", "Aged 4 years and under", 10, census),
        ("E02000001", "msoa", "Aged 50 to 64 years", 20, census),
        ("E02000003", "msoa", "Aged 85 years and over", 7, census),
        ("E02000003", "msoa", "Total: All usual residents", 99, census),
        ("E02000003", "msoa", "Aged 7 years", 99, census),
        ("E02000003", "msoa", "Aged 65 to 74 years", 99, d(2011, 3, 27)),
        ("W02", "msoa", "Aged 65 to 74 years", 99, census),
    ]
    sex = [("E01000001", "Female", 5, census), ("E01000001", "Male", 6, census),
           ("E01000002", "All persons", 50, census), ("E01000003", "Unstated", 2, census)]
    ethnic = [
        ("E01000001", "lsoa", "Ethnic_group:_Asian_Asian_British_or_Asian_Welsh", 1.25, census),
        ("E01000003", "lsoa", "Ethnic_group:_Asian_Asian_British_or_Asian_Welsh", 1.25, census),
        ("E01000003", "lsoa", "Ethnic_group:_Black_Black_British_Black_Welsh_Caribbean_or_African", 3.0, census),
        ("E01000003", "lsoa", "Ethnic_group:_White", 4.0, census),
        ("E01000003", "lsoa", "Ethnic_group:_White:_English", 4.0, census),
    ]
    src = {
        "area_lookup": lookup,
        "commissioner_hierarchy": orgs,
        "census_age": literal_rows(spark, age, age_schema),
        "census_sex": literal_rows(
            spark, sex, "Geography_Code string, Sex string, Count long, Effective_Snapshot_Date date"
        ),
        "census_ethnicity": literal_rows(
            spark, ethnic,
            "Geography_Code string, Geography_Type string, Measure string, Measure_Value double, "
            "Effective_Snapshot_Date date",
        ),
    }
    pops = population_table(src)
    got = {(r.Org_Type, r.Org_Code, r.Category, r.Variable): r.Pop for r in pops.collect()}
    # The area on the border counts in both Sub-ICBs and twice above.
    assert got["Sub-ICB", "15E", "Age Group", "Under65"] == 30
    assert got["Sub-ICB", "A2", "Age Group", "Under65"] == 30
    assert got["National", "England", "Age Group", "Under65"] == 60
    assert got["ICB", "X", "Age Group", "85+"] == 7
    assert got["National", "England", "Gender", "Females"] == 5
    assert got["Sub-ICB", "A2", "Gender", "Other/Not Stated/Not Known"] == 2
    assert got["National", "England", "Ethnicity", "Asian"] == 3  # 2.5 away from zero
    assert got["Sub-ICB", "15E", "Ethnicity", "Asian"] == 1
    assert got["ICB", "X", "Ethnicity", "White"] == 4
    once = population_table(src, assign="first").where("Category = 'Age Group' AND Org_Type = 'National'")
    assert {r.Variable: r.Pop for r in once.collect()}["Under65"] == 30

    metrics = literal_rows(
        spark,
        [(d(2021, 5, 1), "ICB", "X", "Age Group", "85+", 3), (d(2021, 5, 1), "ICB", "X", "Age Group", "85+", 4),
         (d(2021, 5, 1), "Provider", "P1", "Age Group", "85+", 3), (d(2021, 5, 1), "ICB", "X", "Total", "Total", 9)],
        "Month date, Orgtype string, OrgCode string, Category string, Variable string, OpenReferrals long",
    )
    rates = open_referral_rates(metrics, pops).collect()
    assert len(rates) == 3
    known = [r for r in rates if r.Pop is not None]
    assert len(known) == 1 and known[0].OpenReferralsPer100k == pytest.approx(100000.0)
    assert all(r.OpenReferralsPer100k is None for r in rates if r.Pop is None)


def test_one_base_for_both_outputs_and_nothing_left(spark, tmp_path):
    from carepath.sources import staging

    care, months = tables(spark), Window(d(2021, 3, 1), d(2021, 6, 30))
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with staging.StagedRun(spark) as run:
        waits, metrics = pathway_outputs(care, months, RUN, run)
        assert run.built == 1 and len(set(os.listdir(folder)) - before) == 1
        assert pathway_outputs(care, months, RUN, run)[0].count() == waits.count() and run.built == 1
        want = referral_base(care, months)
        assert sorted(map(str, metrics.collect())) == sorted(map(str, main_metrics(want, RUN).collect()))
        assert sorted(map(str, waits.collect())) == sorted(map(str, wait_times(want, RUN).collect()))
        for df in (waits, metrics):
            assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert {f for f in os.listdir(folder) if f.startswith("referral-base")} <= before
    waits.sparkSession.catalog.clearCache()


@pytest.mark.parametrize("limits", [{}, {"least": 1, "share": 0.01}])
def test_bucketed_inputs_give_the_same_base(spark, limits):
    from carepath.sources.staging import StagedRun

    care, months = tables(spark), Window(d(2021, 3, 1), d(2021, 6, 30))
    want = sorted(map(str, referral_base(care, months).collect()))
    folder = spark.conf.get("spark.checkpoint.dir")
    before, known = set(os.listdir(folder)), {t.name for t in spark.catalog.listTables()}
    with StagedRun(spark) as run:
        # With the low limits most records and referrals are hot and stay out of the buckets.
        found = bucketed_base(care, months, run, 3, limits)
        assert run.built == 7 and sorted(map(str, found.collect())) == want
    assert set(os.listdir(folder)) == before and {t.name for t in spark.catalog.listTables()} == known


def test_bucketed_inputs_are_joined_where_they_lie(spark):
    from carepath.registry import care as domain
    from carepath.sources.staging import StagedRun

    folder = "/root/testdata/sf0.001"
    stored, months = domain.stored_tables(spark, folder), domain.months_of(spark, folder)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = lambda lines: [x for x in lines if "Exchange hashpartitioning" in x]
    try:
        with StagedRun(spark) as run:
            joined = plan(bucketed_base(stored, months, run, 4, person_id_from=domain.CUT))
            plain = plan(referral_base(stored, months, person_id_from=domain.CUT))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The records move once to their referrals. (The months and codes, small tables that are
    # broadcast elsewhere, are not in this test.)
    assert sum("(UniqServReqID" in x for x in moved(joined)) == 1 and len(moved(joined)) <= len(moved(plain)) - 7
    stored_sides = [k for k, x in enumerate(joined) if "FileScan" in x and "spark_catalog" in x and "referral_" not in x]
    assert len(stored_sides) == 5
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    for k in stored_sides:  # nothing between the buckets and the join they go into
        node = k
        while "Join [" not in joined[node]:
            assert not moved(joined[node : node + 1])
            node = max(j for j in range(node) if depth(joined[j]) < depth(joined[node]))


def test_codes_are_described_once_per_combination(spark):
    from carepath.operators.refdata import described_once

    df = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"))
    seen = []

    def describe(codes):
        seen.append(codes.count())
        return codes.withColumn("name", F.concat_ws("-", "a", "b"))

    out = described_once(df, ["a", "b"], describe)
    assert seen == [6] and out.columns == ["id", "a", "b", "name"]
    assert {(r.a, r.b, r.name) for r in out.collect()} == {(a, b, a + ("-x" if b else "")) for a in "012" for b in ("x", None)}
    assert out.count() == 3000


def test_rows_move_once_to_their_record_and_once_to_their_referral(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "true"}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    try:
        base = referral_base(tables(spark), Window(d(2021, 3, 1), d(2021, 6, 30)))
        plan = base._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    moved = [x for x in plan if "Exchange hashpartitioning" in x]
    # Neither by referral and person, nor by record and referral, nor by the whole row for distinct().
    assert not [x for x in moved if "__person#" in x or "__diag_person#" in x or "RecordNumber#" in x and "UniqServReqID#" in x]
    assert not [x for x in moved if "hashpartitioning(Month#" in x]


def test_tables_of_records_come_from_one_stored_join(spark):
    from carepath.registry import care as domain

    stored = domain.stored_tables(spark, "/root/testdata/sf0.001")
    plain = domain.pathway_tables(spark, "/root/testdata/sf0.001")
    for name in ("referral", "patient_index", "service_type", "care_contact", "primary_diagnosis"):
        plan = stored[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
        assert stored[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(stored[name]).isEmpty()


def test_metric_sums_have_no_row_per_pair_of_organisations(spark):
    places = {
        "OrgIDProv": F.concat(F.lit("P"), F.col("id") % 10), "OrgIDComm": F.concat(F.lit("C"), (F.col("id") / 10).cast("int")),
        "Provider_Name": F.lit("p"), "Prov_Region_Name": F.lit("r"), "Sub_ICB_Name": F.lit("s"), "ICB_Code": F.lit("i"),
        "ICB_Name": F.lit("i"), "Comm_Region_Name": F.lit(None).cast("string"),
    }
    rest = {
        "Month": F.lit(d(2021, 5, 1)), "TeamType": F.lit("t"), "PrimReason": F.lit("r"),
        "LatestConditionDiagnosisCode": F.lit(None).cast("string"), "LatestDiagnosisArea": F.lit(None).cast("string"),
        "AgeServReferRecDate": F.lit(70), "Gender": F.lit("1"), "EthnicCategory": F.lit("A"),
        **{c: F.lit(1) for c in ("NewRef", "OpenRef", "DischRef", "Refwaiting1stcontact", "RefwithCarePlanCreated")},
    }
    base = spark.range(100).withColumns({**places, **rest})
    assert metric_sums(base).count() == (10 + 10) * 4
    metrics = main_metrics(base, RUN).where("Category = 'Total'").groupBy("Orgtype").agg(F.count("*").alias("n"), F.sum("OpenReferrals").alias("s"))
    assert {r.Orgtype: (r.n, r.s) for r in metrics.collect()} == {
        "Provider": (10, 100), "Sub-ICB": (10, 100), "ICB": (1, 100), "National": (1, 100)
    }


def test_stored_metrics_move_rows_as_numbers(spark, tmp_path):
    care, months = tables(spark), Window(d(2021, 3, 1), d(2021, 6, 30))
    referral_base(care, months).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    # One code with two names, rows that come again, an organisation and flags that are not known.
    again = base.withColumn("Provider_Name", F.lit("Another name"))
    unknown = base.withColumns({"OrgIDProv": F.lit(None).cast("string"), "OpenRef": F.lit(None).cast("int")})
    base.unionByName(again).unionByName(base).unionByName(unknown).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = main_metrics(rows, RUN, stored=True)
    want = main_metrics(rows, RUN)
    assert found.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    plan = metric_sums(rows, stored=True)._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = [x for x in plan if "Exchange hashpartitioning" in x]
    assert len([x for x in moved if "REPARTITION_BY_COL" in x and "__subject#" in x and "__place#" in x]) == 2
    assert not [x for x in moved if "Name" in x or "TeamType" in x]


def test_lines_of_an_order_move_once_and_are_stored_once(spark):
    from carepath.registry import care as domain

    stored = domain.stored_tables(spark, "/root/testdata/sf0.001")
    files = {n: set(stored[n].inputFiles()) for n in ("referral", "patient_index", "service_type", "care_contact", "primary_diagnosis")}
    assert all(f == files["referral"] for f in files.values())


def test_ids_that_are_as_usual_do_not_move(spark):
    from carepath.plans.referral_pathway import _folded, _unfolded

    rows = [("a", "a"), ("b", "a"), (None, "a"), ("a", None), (None, None)]
    df = literal_rows(spark, rows, "other string, usual string")
    folded = _folded(df, "other", "usual")
    assert [r.other for r in folded.collect()] == [None, "b", None, "a", None]
    assert [tuple(r) for r in _unfolded(folded, "other", "usual").select("other", "usual").collect()] == rows
