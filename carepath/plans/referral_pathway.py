"""Referral pathway: diagnosis cohort, waits and caseload metrics."""

from __future__ import annotations

from collections.abc import Hashable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import AGE_BANDS, AGE_UNKNOWN, band_flags, band_label
from ..functions.caseload import caseload_flags, in_period, is_open, wait_days
from ..functions.codes import COHORT_CODES, COHORT_PREFIXES, diagnosis_area, in_codes
from ..functions.dates import Window, as_date, local_time, month_start
from ..functions.groups import (
    ATTENDED,
    CONTACT_CHANNELS,
    ETHNIC_DEFAULT,
    ETHNIC_GROUPS,
    GENDER_DEFAULT,
    GENDER_GROUPS,
    ICB,
    MISSING,
    PROVIDER,
    SUB_ICB,
)
from ..functions.labels import group_codes, key, order_label
from ..operators.events import earliest_latest, first_event, primary_secondary
from ..operators.hotkeys import hot_in_any, is_hot
from ..operators.refdata import current, decode, described_once, era_key, numbered
from ..operators.rollup import ALL, Category, Geography, category_sums, geography_sums
from ..sources.publish import stamp
from ..sources.staging import StagedRun
from ..sources.tables import Tables
from .organisations import national, with_commissioner, with_provider

# Team and reason of the waits table, which differ by data source,
# the first month whose person ids agree, and the submission mark.
TEAM = "Memory Services/Clinic/Drop in service"
REASON = "Organic brain disorder"
PERSON_ID_FROM = date(2021, 4, 1)
SUBMISSION = "R"

GEOGRAPHIES = [
    Geography(
        PROVIDER,
        "OrgIDProv",
        {"OrgCode": "OrgIDProv", "OrgName": "Provider_Name", "Region": "Prov_Region_Name"},
    ),
    Geography(
        SUB_ICB,
        "OrgIDComm",
        {"OrgCode": "OrgIDComm", "OrgName": "Sub_ICB_Name", "Region": "Comm_Region_Name"},
    ),
    Geography(
        ICB,
        "ICB_Code",
        {"OrgCode": "ICB_Code", "OrgName": "ICB_Name", "Region": "Comm_Region_Name"},
    ),
    national(OrgCode="all", OrgName="all", Region="region"),
]
CATEGORIES = [
    ALL,
    Category("Age Group", "AgeGroup"),
    Category("Gender", "GenderGroup"),
    Category("Ethnicity", "EthnicGroup"),
]
METRICS = {
    "NewReferrals": "NewRef",
    "OpenReferrals": "OpenRef",
    "Discharges": "DischRef",
    "OpenWaitingFirstCont": "Refwaiting1stcontact",
    "OpenRefwithCarePlanCreated": "RefwithCarePlanCreated",
}


def _coded(df: DataFrame, code: str, tz: str | None, wildcards: bool) -> DataFrame:
    return (
        df.where(in_codes(code, COHORT_CODES, COHORT_PREFIXES, wildcards))
        .select(
            "Der_Person_ID",
            "UniqServReqID",
            local_time("CodedDiagTimestamp", tz).alias("CodedDiagTimestamp"),
            F.col(code).alias("DiagnosisCode"),
            diagnosis_area(code).alias("DiagnosisArea"),
        )
        .distinct()
    )


def diagnosis_cohort(
    tables: Tables,
    tz: str | None = None,
    include_secondary_only: bool = False,
    wildcards: bool = False,
) -> DataFrame:
    """Diagnoses that put a person in the cohort."""
    return primary_secondary(
        _coded(tables["primary_diagnosis"], "PrimDiag", tz, wildcards),
        _coded(tables["secondary_diagnosis"], "SecDiag", tz, wildcards),
        ["Der_Person_ID", "UniqServReqID", "CodedDiagTimestamp"],
        include_secondary_only,
    )


def ranked_diagnoses(cohort: DataFrame) -> DataFrame:
    """Earliest and latest diagnosis of each referral.

    At one time, MCI is taken as the earliest and Condition as the latest.
    """
    ts, mci = F.col("CodedDiagTimestamp"), F.col("DiagnosisArea") == "MCI"
    return earliest_latest(
        cohort,
        ["UniqServReqID", "Der_Person_ID"],
        ["CodedDiagTimestamp", "DiagnosisCode", "DiagnosisArea"],
        first=[ts, (~mci).cast("int")],
        last=[ts, (~mci).cast("int")],
    )


def first_contacts(care_contact: DataFrame) -> DataFrame:
    return first_event(
        care_contact,
        ["UniqServReqID", "Der_Person_ID"],
        "CareContDate",
        F.col("AttendOrDNACode").isin(ATTENDED) & F.col("ConsMechanismMH").isin(CONTACT_CHANNELS),
        "FirstContactDate",
    )


def _plan_span(care_plan: DataFrame) -> DataFrame:
    """First and last plan date of a record, and whether any plan has no date.

    All that a record's plans can add to the base is a flag of 0, of 1 or both, so
    they are summed up before the join and no record multiplies its referrals.
    """
    created = as_date("CarePlanCreatDate")
    return care_plan.groupBy("RecordNumber").agg(
        F.min(created).alias("__plan_first"),
        F.max(created).alias("__plan_last"),
        F.max(F.col("CarePlanCreatDate").isNull().cast("int")).alias("__plan_undated"),
    )


def _plan_flags(open_: Column, end: Column) -> Column:
    """Array of the distinct care-plan flags of a row.

    A plan that is not known to lie within the period counts as none, so there is a flag
    always, also where the period has no end.
    """
    no = F.lit(False)
    with_plan = F.coalesce(open_ & (F.col("__plan_first") <= end), no)
    without = (
        ~F.coalesce(open_, no)
        | F.col("__plan_first").isNull()
        | ~F.coalesce(F.col("__plan_last") <= end, no)
        | (F.col("__plan_undated") == 1)
    )
    none = F.array().cast("array<int>")
    return F.concat(
        F.when(with_plan, F.array(F.lit(1))).otherwise(none),
        F.when(without, F.array(F.lit(0))).otherwise(none),
    )


def _with_team(codes: DataFrame, tables: Tables) -> DataFrame:
    current_types = current(tables["team_type"], end=None, flag=("Is_Latest", 1))
    return decode(codes, "ServTeamTypeRefToMH", current_types, "TeamType", collated=True)


def _with_organisations(codes: DataFrame, tables: Tables) -> DataFrame:
    """Reason and present organisations of raw codes (__comm, __prov, PrimReasonReferralMH)."""
    codes = decode(
        codes,
        "PrimReasonReferralMH",
        current(tables["referral_reason"], end=None, flag=("Is_Latest", 1)),
        "PrimReason",
        collated=True,
    )
    codes = with_commissioner(
        codes,
        "__comm",
        tables["commissioner_code_changes"],
        current(tables["commissioner_hierarchy"]),
        {
            "OrgIDComm": "Organisation_Code",
            "Sub_ICB_Name": "Organisation_Name",
            "ICB_Code": "STP_Code",
            "ICB_Name": "STP_Name",
            "Comm_Region_Name": "Region_Name",
            "Comm_Region_Code": "Region_Code",
        },
    )
    return with_provider(
        codes,
        "__prov",
        tables["provider_successor"],
        tables["provider_hierarchy"],
        {
            "OrgIDProv": "Organisation_Code",
            "Provider_Name": "Organisation_Name",
            "Prov_Region_Name": "Region_Name",
        },
    )


def _joined_where_it_lies(df: DataFrame, other: DataFrame, dealt: str, same: str) -> DataFrame:
    """Left join by both columns of rows that lie by the first one.

    The second is compared as a range: as a join key it would have Spark deal both sides anew.
    """
    right = other.withColumnsRenamed({dealt: "__dealt", same: "__same"})
    matched = (F.col(dealt) == F.col("__dealt")) & F.col(same).between(F.col("__same"), F.col("__same"))
    return df.join(right, matched, "left").drop("__dealt", "__same")


def _folded(df: DataFrame, column: str, usual: str) -> DataFrame:
    """The column as nothing where it is what the usual one is, which moves in less space."""
    same = F.col(column).eqNullSafe(F.col(usual))
    return df.withColumn(f"{column}_usual", same).withColumn(column, F.when(~F.col(f"{column}_usual"), F.col(column)))


def _few_valued_first(df: DataFrame) -> DataFrame:
    """df with what neighbouring rows share in front, and the rest together: it moves in less space."""
    few = [c for c in FEW_VALUED if c in df.columns]
    return df.select(*few, *[c for c in df.columns if c not in few])


def _unfolded(df: DataFrame, column: str, usual: str) -> DataFrame:
    whole = F.when(F.col(f"{column}_usual"), F.col(usual)).otherwise(F.col(column))
    return df.withColumn(column, whole).drop(f"{column}_usual")


#: Columns of few values; by those named here rows lie side by side before they move to their referral.
MOVED_ORDER = [
    "ReportingPeriodStartDate", "ServTeamTypeRefToMH", "PrimReasonReferralMH", "Gender", "EthnicCategory",
    "OrgIDComm", "OrgIDProv",
]
FEW_VALUED = [
    *MOVED_ORDER[:-2], "ReportingPeriodEndDate", "UniqMonthID", "__person_usual", "__person", "__diag_person_usual",
    "__diag_person", "RefwithCarePlanCreated",
]

BASE_COLUMNS = [
    "Month",
    "FirstContactDate", "UniqServReqID", "Der_Person_ID",
    "OrgIDComm", "Sub_ICB_Name", "ICB_Code", "ICB_Name", "Comm_Region_Name",
    "Comm_Region_Code", "OrgIDProv", "Provider_Name", "Prov_Region_Name",
    "ReferralRequestReceivedDate", "ServDischDate", "UniqMonthID", "EthnicCategory",
    "Gender", "AgeServReferRecDate", "ReportingPeriodStartDate", "ReportingPeriodEndDate",
    "ServTeamTypeRefToMH", "TeamType", "PrimReasonReferralMH", "PrimReason",
    "WaitRefContact", "FirstContactDateMonthFlag", "NewRef", "DischRef", "OpenRef", "Refwaiting1stcontact",
    "RefwithCarePlanCreated",
    "EarliestDiagDate", "EarliestConditionDiagnosisCode", "EarliestDiagnosisArea",
    "WaitRefDiag", "EarliestDiagDateMonthFlag",
    "LatestConditionDiagnosisCode", "LatestDiagnosisArea", "RefToEarliestDiagOrder",
]

#: Record tables and the column that each is bucketed by.
BUCKETED_BY = {
    "referral": "RecordNumber",
    "patient_index": "RecordNumber",
    "care_plan": "RecordNumber",
    "service_type": "RecordNumber",
    "care_contact": "UniqServReqID",
    "primary_diagnosis": "UniqServReqID",
    "secondary_diagnosis": "UniqServReqID",
}


def bucketed_base(
    tables: Tables, months: Window, staged: StagedRun, buckets: int, limits: dict | None = None, **options
) -> DataFrame:
    """The base from inputs that are written once in buckets by record and by referral.

    Joins and sums by record need no exchange then, and the base as a whole has one, from
    records to referrals. A record or referral with more rows than a bucket should have is
    left out of the buckets: its rows are joined from the tables as they are, where adaptive
    execution splits them. Worth it when the inputs serve several months or outputs.
    """
    hot = hot_in_any(tables, BUCKETED_BY, buckets, **(limits or {}))

    def cold(name: str) -> DataFrame:
        keys = [c for c in hot if c in tables[name].columns and hot[c]]
        df = tables[name]
        for c in keys:
            df = df.where(~is_hot(c, hot[c]))
        return df

    inputs = {n: staged.bucketed(cold(n), [c], buckets, n.replace("_", "-")) for n, c in BUCKETED_BY.items()}
    base = staged.part(lambda: referral_base({**tables, **inputs}, months, buckets=buckets, **options))
    if not any(hot.values()):
        return base
    busy = F.lit(False)
    for c, values in hot.items():
        busy = busy | is_hot(c, values)
    rest = {**tables, "referral": tables["referral"].where(busy)}
    # A row is described by its own record and referral, so the two parts share no row.
    return base.unionByName(staged.part(lambda: referral_base(rest, months, **options)))


def referral_base(
    tables: Tables,
    months: Window,
    tz: str | None = None,
    include_secondary_only: bool = False,
    wildcards: bool = False,
    one_row_per_referral: bool = False,
    person_id_from: date = PERSON_ID_FROM,
    buckets: int | None = None,
) -> DataFrame:
    """One row per referral and reporting month, with waits and status flags.

    A record with care plans on both sides of the period end gives two rows, as
    does a referral with two team types; ``one_row_per_referral`` keeps the greater
    care-plan flag.

    Rows move twice: to their record, which all that is known by record meets, and to their
    referral, where contacts, diagnoses and the rows that are equal meet. ``buckets`` says
    that the inputs lie in so many buckets by record and by referral (see BUCKETED_BY).
    """

    def to(df: DataFrame, column: str) -> DataFrame:
        return df.repartition(column) if buckets is None else df

    flags = (
        current(tables["submission_flags"], end=None, flag=("Der_IsLatest", "Y"))
        .where(F.col("ReportingPeriodStartDate").cast("date").between(*months))
        .select("NHSEUniqSubmissionID", "ReportingPeriodStartDate", "ReportingPeriodEndDate")
    )
    start, end = F.col("ReportingPeriodStartDate"), F.col("ReportingPeriodEndDate")
    teams = (
        to(tables["service_type"], "RecordNumber")
        .select(
            "UniqServReqID",
            "RecordNumber",
            F.col("Der_Person_ID").alias("__diag_person"),
            "ServTeamTypeRefToMH",
        )
        .distinct()
    )
    contacts = first_contacts(tables["care_contact"]).withColumnRenamed("Der_Person_ID", "__person")
    ranked = ranked_diagnoses(
        diagnosis_cohort(tables, tz, include_secondary_only, wildcards)
    ).select(
        "UniqServReqID",
        F.col("Der_Person_ID").alias("__diag_person"),
        F.col("EarliestCodedDiagTimestamp").alias("EarliestDiagDate"),
        F.col("EarliestDiagnosisCode").alias("EarliestConditionDiagnosisCode"),
        "EarliestDiagnosisArea",
        F.col("LatestDiagnosisCode").alias("LatestConditionDiagnosisCode"),
        "LatestDiagnosisArea",
    )
    recorded = tables["referral"].join(flags, "NHSEUniqSubmissionID", "inner")
    named = recorded.withColumn("__person", era_key(start, person_id_from, "Der_Person_ID", "Person_ID"))
    named = _few_valued_first(_folded(named, "__person", "Der_Person_ID").drop("NHSEUniqSubmissionID", "Person_ID"))
    base = (
        to(named, "RecordNumber")
        .join(tables["patient_index"].select("EthnicCategory", "Gender", "RecordNumber"), "RecordNumber")
        .join(_plan_span(tables["care_plan"]), "RecordNumber", "left")
        .transform(lambda df: _joined_where_it_lies(df, teams, "RecordNumber", "UniqServReqID"))
        .transform(lambda df: _folded(df, "__diag_person", "Der_Person_ID"))
        .sortWithinPartitions(*MOVED_ORDER)
        .withColumn(
            "RefwithCarePlanCreated", F.explode(_plan_flags(is_open("ServDischDate", as_date(end)), as_date(end)))
        )
        .drop("RecordNumber", "__plan_first", "__plan_last", "__plan_undated")
        .transform(_few_valued_first)
    )
    base = base.repartition("UniqServReqID") if buckets is None else base.repartition(buckets, "UniqServReqID")
    for person in ("__person", "__diag_person"):
        base = _unfolded(base, person, "Der_Person_ID")
    base = _joined_where_it_lies(base, to(contacts, "UniqServReqID"), "UniqServReqID", "__person")
    base = _joined_where_it_lies(base, to(ranked, "UniqServReqID"), "UniqServReqID", "__diag_person")
    base = described_once(
        base, ["ServTeamTypeRefToMH"], lambda codes: _with_team(codes, tables), tables["service_type"]
    ).withColumn("TeamType", F.coalesce("TeamType", F.lit(MISSING)))
    raw = {"OrgIDComm": "__comm", "OrgIDProv": "__prov"}
    base = described_once(
        base.withColumnsRenamed(raw),
        [*raw.values(), "PrimReasonReferralMH"],
        lambda codes: _with_organisations(codes, tables),
        recorded.withColumnsRenamed(raw),
    )
    # Rows are told apart by what is not derived from other columns.
    columns, plan = BASE_COLUMNS, "RefwithCarePlanCreated"
    base = base.select(*[c for c in columns if c in base.columns])
    if one_row_per_referral:
        columns = [*[c for c in columns if c != plan], plan]
        base = base.groupBy(*[c for c in base.columns if c != plan]).agg(F.max(plan).alias(plan))
    else:
        base = base.distinct()
    received, contact = F.col("ReferralRequestReceivedDate"), F.col("FirstContactDate")
    diagnosed = F.col("EarliestDiagDate").cast("date")
    derived = {
        "Month": month_start(start),
        "WaitRefContact": wait_days(received, contact, end),
        "FirstContactDateMonthFlag": in_period(contact, start, end),
        **caseload_flags(received, "ServDischDate", contact, start, end),
        "WaitRefDiag": wait_days(received, diagnosed, end),
        "EarliestDiagDateMonthFlag": in_period(diagnosed, start, end),
        "RefToEarliestDiagOrder": order_label(
            diagnosed, received,
            "Diagnosis After Referral", "Diagnosis Before Referral", "No Diagnosis",
        ),
    }
    return base.withColumns(derived).select(*columns)


def laid_out(base: DataFrame) -> DataFrame:
    """The base for writing: rows of a group side by side, which makes what metrics move small."""
    return base.sortWithinPartitions(*BASE_ORDER)


def pathway_outputs(
    tables: Tables, months: Window, run: datetime, staged: StagedRun, key: Hashable = "referral-base", **options
) -> tuple[DataFrame, DataFrame]:
    """Waits and metrics from one base, built once in the staged run under the given key.

    Write both before the run is closed, which removes the base.
    """
    base = staged.table(key, lambda: laid_out(referral_base(tables, months, **options)), "referral-base")
    return wait_times(base, run), main_metrics(base, run)


def wait_times(
    base: DataFrame,
    run: datetime,
    team: str = TEAM,
    reason: str = REASON,
    submission: str = SUBMISSION,
) -> DataFrame:
    """Referrals of one team and reason with banded waits."""
    shown = base.where((key("TeamType") == team.upper()) & (key("PrimReason") == reason.upper()))
    waits = {
        **band_flags("WaitRefContact", "Contact", requires="UniqServReqID",
                     total="TotalReferralsWithContact"),
        **band_flags("WaitRefDiag", "Diag", requires="UniqServReqID",
                     total="TotalReferralsWithDiag"),
    }
    return stamp(
        shown.withColumns(
            {
                "ConditionDiagnosis": F.col("EarliestConditionDiagnosisCode")
                .isNotNull().cast("int").cast("string"),
                **waits,
                "DataSubmissionType": F.lit(submission),
            }
        ),
        run,
    )


#: What metrics are kept by, besides organisation and patient group.
METRIC_KEYS = [
    "Month", "TeamType", "PrimReason", "LatestConditionDiagnosisCode", "LatestDiagnosisArea", "ConditionDiagnosis",
]
BASE_ORDER = [*METRIC_KEYS[:5], "OrgIDProv", "OrgIDComm"]
PLACES = list(dict.fromkeys(c for g in GEOGRAPHIES for c in g.columns.values()))


#: Levels that no other level can be summed from, with those that are.
LEVELS = {PROVIDER: GEOGRAPHIES[:1], SUB_ICB: GEOGRAPHIES[1:]}
PATIENT_GROUPS = [c.column for c in CATEGORIES if c.column]


def metric_sums(base: DataFrame, stored: bool = False) -> DataFrame:
    """Caseload by provider and by Sub-ICB, per patient group: the finest levels of the metrics.

    A row counts once at either level (column Level), never per pair of provider and Sub-ICB, as
    pairs are nearly as many as rows. Rows move to their group before they are summed: what
    is broken down by category afterwards are sums, whose number doesn't grow with the rows.
    ``stored`` says that the base lies in files, so that it can be read again for numbers: rows
    move as a month and three of these, without names and labels, and are counted, then summed.
    """
    banded = base.withColumns(
        {
            "AgeGroup": band_label("AgeServReferRecDate", AGE_BANDS, AGE_UNKNOWN),
            "GenderGroup": group_codes("Gender", GENDER_GROUPS, GENDER_DEFAULT),
            "EthnicGroup": group_codes("EthnicCategory", ETHNIC_GROUPS, ETHNIC_DEFAULT),
            "ConditionDiagnosis": F.col("LatestConditionDiagnosisCode").isNotNull().cast("int"),
        }
    )
    subject, patients = METRIC_KEYS[1:], [*PATIENT_GROUPS, *METRICS.values()]
    rows = banded.select("Month", *subject, *PLACES, *patients)
    if stored:
        rows, subjects = numbered(rows, subject, "__subject", banded)
        rows, kinds = numbered(rows, patients, "__kind", banded)
    out = []
    for level, geographies in LEVELS.items():
        places = list(dict.fromkeys(c for g in geographies for c in g.columns.values()))
        if stored:
            placed, known = numbered(rows, places, "__place", banded)
            keys = ["Month", "__subject", "__place"]
            moved = placed.select(*keys, "__kind").repartition(*keys)
            sums = moved.groupBy(*keys, "__kind").agg(F.count("*").alias("__rows")).join(kinds, "__kind")
            measures = {n: F.sum(F.col("__rows") * F.col(c)) for n, c in METRICS.items()}
        else:
            keys = [*METRIC_KEYS, *places]
            moved = rows.select(*keys, *patients).repartition(*keys)
            sums = moved.groupBy(*keys, *PATIENT_GROUPS).agg(*[F.sum(c).alias(n) for n, c in METRICS.items()])
            measures = {n: F.sum(n) for n in METRICS}
        by_group = category_sums(sums, keys, CATEGORIES, measures)
        if stored:
            by_group = by_group.join(subjects, "__subject").join(known, "__place")
        out.append(
            by_group.select(
                *METRIC_KEYS,
                F.lit(level).alias("Level"),
                *[F.col(c) if c in places else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in PLACES],
                "Category", "Variable", *METRICS,
            )
        )
    return out[0].unionByName(out[1])


def metrics_from_sums(sums: DataFrame, run: datetime, submission: str = SUBMISSION) -> DataFrame:
    """The metrics of every organisation level, from sums built now or stored."""
    group = ["Category", "Variable"]
    levels = [
        geography_sums(
            sums.where(F.col("Level") == level), [*METRIC_KEYS, *group], geographies, list(METRICS)
        ).select(*METRIC_KEYS, "Orgtype", "OrgCode", "OrgName", "Region", *group, *METRICS)
        for level, geographies in LEVELS.items()
    ]
    counts = levels[0].unionByName(levels[1])
    renamed = counts.withColumnRenamed("LatestConditionDiagnosisCode", "Condition Diagnosis Code")
    return stamp(renamed.withColumn("DataSubmissionType", F.lit(submission)), run)


def main_metrics(base: DataFrame, run: datetime, submission: str = SUBMISSION, stored: bool = False) -> DataFrame:
    """Caseload by organisation level and patient group, with and without a diagnosis."""
    return metrics_from_sums(metric_sums(base, stored), run, submission)
