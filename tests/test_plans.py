"""Whole jobs on hand-written tables with hand-computed answers."""

import math
from datetime import date as d
from datetime import datetime as t

import pytest
from domain import (
    activity_hierarchy,
    diagnosis_rates,
    episode,
    hierarchy,
    reference,
    spell,
)
from pyspark.sql import functions as F

from carepath.functions.dates import Window
from carepath.plans.admissions import COUNTS, admissions, admissions_counts
from carepath.plans.diagnosis_rate import diagnosis_rate, rates
from carepath.plans.prescribing import prescribing
from carepath.plans.readmissions import readmission_counts, readmissions
from carepath.sources.tables import literal_rows

RUN = t(2024, 6, 1, 9, 0)


def by(df, *keys):
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in keys)
        assert k not in out, k
        out[k[0] if len(k) == 1 else k] = r
    return out


def limits(p, n):
    s = 3 * math.sqrt(p * (1 - p) / n)
    return p + s, p - s


def test_diagnosis_rate(spark):
    tables = {**reference(spark), **diagnosis_rates(spark), "commissioner_hierarchy": hierarchy(spark)}
    points = by(rates(tables), "Org Type", "Org Code", "Effective_Snapshot_Date")
    feb, mar, apr, may = d(2020, 2, 1), d(2020, 3, 1), d(2020, 4, 1), d(2020, 5, 1)
    alpha = points["Sub-ICB", "A1", feb]
    assert (alpha["CONDITION_ESTIMATE_65_PLUS"], alpha["CONDITION_REGISTER_65_PLUS"]) == (200.0, 130.0)
    assert alpha["CONDITION_RATE_65_PLUS"] == 0.65
    assert alpha["ICB Name"] == "ICB X" and alpha["Region Name"] is None
    assert points["Sub-ICB", "A1", apr]["CONDITION_REGISTER_65_PLUS"] == 140.0
    icb = points["ICB", "X", feb]
    assert (icb["CONDITION_ESTIMATE_65_PLUS"], icb["Org Name"]) == (300.0, "ICB X")
    assert points["Region", "R1", feb]["ICB Name"] is None
    # National rows are the published ones, not the sum of the parts.
    assert points["National", "England", feb]["CONDITION_ESTIMATE_65_PLUS"] == 1000.0
    assert points["Sub-ICB", None, feb]["CONDITION_ESTIMATE_65_PLUS"] == 10.0

    chart = by(diagnosis_rate(tables), "Org Type", "Org Code", "Effective_Snapshot_Date")
    assert ("Sub-ICB", None, feb) not in chart
    assert ("Sub-ICB", "A1", mar) not in chart  # the day the phases meet
    p2 = (130 + 100 + 140 + 130) / (200 + 200 + 210 + 190)
    before, after = chart["Sub-ICB", "A1", feb], chart["Sub-ICB", "A1", may]
    assert before["pbar"] == 130 / 200 and before["pbar2"] == p2
    assert after["pbar"] == (140 + 130) / (210 + 190) and after["pbar2"] == p2
    assert (after["UCL"], after["LCL"]) == pytest.approx(limits(270 / 400, 190), rel=1e-12)
    assert (after["UCL2"], after["LCL2"]) == pytest.approx(limits(p2, 190), rel=1e-12)
    # More registered than estimated: no real limits.
    odd = chart["Sub-ICB", "A3", may]
    assert odd["pbar"] == 1.2 and odd["UCL"] is None and odd["LCL"] is None
    closed = by(diagnosis_rate(tables, closed="after"), "Org Type", "Org Code", "Effective_Snapshot_Date")
    assert closed["Sub-ICB", "A1", mar]["pbar"] == (100 + 140 + 130) / (200 + 210 + 190)


def test_prescribing(spark):
    schema = (
        "Month timestamp_ntz, Type string, Code string, `Without Psychosis Diagnosis` double, "
        "`With Psychosis Diagnosis` double, `Condition Register` double"
    )
    old = [
        (t(2022, 8, 1), "CCG", "OLD1", 10.0, 5.0, 100.0),
        (t(2022, 8, 1), "CCG", "OLD2", 20.0, 5.0, 100.0),
        (t(2022, 8, 1), "CCG", "NOPE", 1.0, 1.0, 10.0),
        (t(2022, 8, 1), "National", "ENG", 300.0, 100.0, 2000.0),
    ]
    new = [(t(2022, 10, 1), "SUB_ICB_LOC", "A1x", 1.0, 1.0, 1.0), (t(2022, 10, 1), "SUB_ICB_LOC", "OLD1", 30.0, 8.0, 200.0)]
    tables = {
        **reference(spark),
        "commissioner_hierarchy": hierarchy(spark),
        "antipsychotic_old": literal_rows(spark, old, schema),
        "antipsychotic_new": literal_rows(spark, new, schema),
    }
    chart = by(prescribing(tables, keep_unmatched=False), "Org Type", "Org Code", "Effective_Snapshot_Date")
    row = chart["Sub-ICB", "A1", d(2022, 8, 1)]
    assert (row["pbar"], row["pbar2"]) == (60 / 400, 18 / 400)
    assert (row["UCL2"], row["LCL2"]) == pytest.approx(limits(18 / 400, 200), rel=1e-12)
    assert row["Proportion_of_DEM_WITH_ANTI_PSY_AND_NO_PSY_DIAG"] == 0.15
    assert chart["National", "England", d(2022, 8, 1)]["pbar"] == 0.15
    assert not [k for k in chart if k[1] is None]
    kept = [r for r in prescribing(tables).collect() if r["Org Code"] is None]
    assert {r["Org Type"] for r in kept} == {"Sub-ICB", "ICB", "Region"} and len(kept) == 3
    assert all(r["pbar"] == 2 / 11 and r["DEM_REGISTER"] is None for r in kept)


def activity(spark, **facts):
    return {**reference(spark), "commissioner_hierarchy": activity_hierarchy(spark), **facts}


WINDOW = Window(d(2024, 1, 1), d(2024, 2, 29))


def test_admissions(spark):
    rows = (
        [dict()] * 8
        + [dict(comm="OLD1", sex="2", age=60, all="F0281,G318")] * 3
        + [dict(comm="W1", prov="P0"), dict(comm="E1", prov="P3"), dict(comm="N1", prov="zz")]
        + [dict(comm="CHAIN1")]  # one hop only, so no organisation
        + [dict(comm="D4U1Y", diag="R41X", all="F050 F067", src="51")] * 10
        # Admitted before the window, discharged late on its last day.
        + [dict(adm=t(2023, 12, 30), dis=t(2024, 2, 29, 23, 59), dest="98")]
        + [dict(dis=None, adm=t(2024, 2, 3))]
        # Left out: not first, not emergency, another class, outside the window.
        + [dict(num=2), dict(method="11"), dict(cls="3"), dict(adm=t(2024, 3, 1), dis=None)]
    )
    spells = [dict(los=n) for n in (0, 1, 2, 3, 4, 10, 11, 21, 22)] + [dict(los=None)]
    tables = activity(spark, episode=episode(spark, rows), spell=spell(spark, spells))
    counts = admissions_counts(tables, WINDOW)
    jan, feb = d(2024, 1, 1), d(2024, 2, 1)
    names = list(COUNTS)
    got = by(counts, "Month", "GroupType", "GeographyCode", "Category", "Variable")
    england = got[jan, "National", "England", "Total", "Total"]
    assert [england[n] for n in names] == [25.0, 22.0, 15.0, 10.0, 10.0]
    assert england["RegionCode"] == "All Regions"
    assert got[jan, "National", "England", "Gender", "Male"][names[0]] == 22.0
    assert got[jan, "National", "England", "Admission Source", "Missing/invalid"][names[0]] == 10.0
    untitled = got[jan, "National", "England", "Primary Diagnosis", None]
    assert untitled[names[0]] == 10.0 and untitled["Primary Diagnosis Chapter"] == "XVIII: Symptoms"
    titled = got[jan, "National", "England", "Primary Diagnosis", "F03: Unspecified condition"]
    assert titled["Primary Diagnosis Chapter"] == "V: Mental disorders"
    assert got[jan, "Provider", "P1", "Total", "Total"][names[0]] == 23.0  # P0 became P1
    assert got[jan, "Provider", "Other", "Total", "Total"][names[0]] == 2.0
    assert got[feb, "Provider", "P1", "Total", "Total"][names[0]] == 1.0
    assert got[jan, "Sub-ICB", "A1", "Total", "Total"][names[0]] == 11.0
    assert got[jan, "Sub-ICB", "A1", "Total", "Total"]["RegionCode"] == "London"
    assert got[jan, "Sub-ICB", "Other", "Total", "Total"][names[0]] == 4.0
    thames = got[jan, "Sub-ICB", "U2G6B", "Total", "Total"]
    assert thames[names[0]] == pytest.approx(5.88618993418278)
    assert thames["RegionCode"] == "South East" and thames["GeographyName"].startswith("NHS THAMES")
    assert got[jan, "ICB", "QRL", "Total", "Total"][names[3]] == pytest.approx(2.29339252148803)
    shared = [r for k, r in got.items() if k[:2] == (jan, "Sub-ICB") and k[3] == "Total"]
    assert sum(r[names[0]] for r in shared) == pytest.approx(25.0)
    # Discharges are counted by their own month.
    assert got[feb, "National", "England", "Discharge Destination", "Missing/invalid"][names[0]] == 1.0
    assert got[jan, "National", "England", "Discharge Destination", "Home"][names[0]] == 25.0
    stay = {k[4]: r[names[0]] for k, r in got.items() if k[1:4] == ("National", "England", "Length of Stay")}
    assert stay == {
        "1 Day or less": 2, "Between 2 and 3 Days": 2, "Between 4 and 10 Days": 2,
        "Between 11 and 21 Days": 2, "More than 21 Days": 1, None: 1,
    }
    shown = by(
        admissions(tables, WINDOW, RUN, staged=True).where("GroupType <> 'Provider'"),
        "Month", "GroupType", "GeographyName", "Category", "Variable",
    )
    row = shown[jan, "National", "England", "Total", "Total"]
    assert [row[n] for n in names] == ["25", "22", "15", "10", "10"]
    assert row["SnapshotDate"] == RUN
    assert shown[jan, "National", "England", "Gender", "Female"][names[0]] == "*"
    exact = by(
        admissions(tables, WINDOW, RUN, digits=3).where("Category = 'Total' AND GroupType = 'ICB'"),
        "Month", "GeographyName",
    )
    assert exact[jan, "ICB X"][names[0]] == "11.000"


def test_readmissions(spark):
    def stay(person, adm, dis, **more):
        return dict(person=person, adm=adm, dis=dis, **more)

    rows = [
        # Two discharges before one admission: the earlier one counts.
        stay("p1", t(2023, 12, 1), t(2023, 12, 5), all="F03"),
        stay("p1", t(2024, 1, 2), t(2024, 1, 31, 22, 0)),
        stay("p1", t(2024, 2, 2), t(2024, 2, 4), prov="P0", comm="OLD1"),
        stay("p1", t(2024, 2, 20), None),
        # 30 and 31 days.
        stay("p2", t(2023, 12, 1), t(2024, 1, 10), age=64, all="F059"),
        stay("p2", t(2024, 2, 9), None, comm="D4U1Y"),
        stay("p3", t(2023, 12, 1), t(2024, 1, 10), all="F067"),
        stay("p3", t(2024, 2, 10), None, comm="D4U1Y"),
        # Gap beyond 90 days: a pair in no bucket.
        stay("p4", t(2023, 11, 1), t(2023, 11, 5)),
        stay("p4", t(2024, 2, 29), None),
        # No person, another class, not an emergency: nothing.
        stay(None, t(2023, 12, 1), t(2024, 1, 10)),
        stay(None, t(2024, 2, 1), None),
        stay("p5", t(2023, 12, 1), t(2024, 1, 10), cls="2"),
        stay("p5", t(2024, 2, 1), None),
        stay("p6", t(2023, 12, 1), t(2024, 1, 10), method="11"),
        stay("p6", t(2024, 2, 1), None),
    ]
    tables = activity(spark, spell=spell(spark, rows))
    counts = readmission_counts(tables, d(2024, 2, 1), 1)
    got = by(counts, "Month", "Org_Type", "Organisation_Name", "AdmissionGroup")
    feb = d(2024, 2, 1)
    v = ["Readmissions30days", "Readmissions60days", "Readmissions90days"]
    england = {k[3]: [r[c] for c in v] for k, r in got.items() if k[1] == "National"}
    assert england["Emergency Admissions"] == [1, 2, 0]
    assert england["Emergency Admissions - Condition Diagnosis"] == [0, 1, 0]
    assert england["Emergency Admissions - MCI Diagnosis"] == [0, 1, 0]
    assert england["Emergency Admissions - Delirium Diagnosis"] == [1, 0, 0]
    assert england["Emergency Admissions - 65+"] == [0, 2, 0]
    # p1: the first admission of February counts, at the provider's successor.
    one = got[feb, "Provider", "Hospital One", "Emergency Admissions"]
    assert [one[c] for c in v] == [1, 2, 0]
    # Empty buckets stay NULL below; weighted counts are rounded.
    alpha = got[feb, "Sub-ICB", "Alpha 26", "Emergency Admissions"]
    assert [alpha[c] for c in v] == [None, 1, None] and alpha["Region Name"] == "London"
    thames = got[feb, "Sub-ICB", "NHS THAMES VALLEY ICB - U2G6B", "Emergency Admissions"]
    assert [thames[c] for c in v] == [1, 1, None]
    surrey = got[feb, "ICB", "NHS SURREY AND SUSSEX INTEGRATED CARE BOARD", "Emergency Admissions"]
    assert [surrey[c] for c in v] == [0, 0, None]
    latest = readmission_counts(tables, d(2024, 2, 1), 1, pick="latest")
    last = by(latest, "Month", "Org_Type", "Organisation_Name", "AdmissionGroup")
    assert [last[feb, "National", "England", "Emergency Admissions"][c] for c in v] == [2, 1, 0]
    # Several months in one job give what each month gives alone.
    many = readmission_counts(tables, d(2023, 12, 1), 4).where(F.col("Month") == feb)
    assert sorted(map(str, many.collect())) == sorted(map(str, counts.collect()))
    shown = by(
        readmissions(tables, d(2024, 2, 1), RUN, 1, staged=True),
        "Org_Type", "Organisation_Name", "AdmissionGroup",
    )
    assert shown["National", "England", "Emergency Admissions"][v[2]] == "*"
    assert shown["Sub-ICB", "Alpha 26", "Emergency Admissions"][v[2]] is None
