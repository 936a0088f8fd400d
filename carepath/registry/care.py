"""Referral pathway and population, end to end on tables derived from the given ones.

An order is a referral, reported in each month in which a line of it ships; its lines
are contacts, diagnoses and care plans. Customers are the people of small areas.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import as_date, month_bounds, month_end, month_start
from ..functions.labels import recode
from ..plans.population import area_lookup, open_referral_rates, population_table
from ..plans.referral_pathway import bucketed_base, laid_out, main_metrics, pathway_outputs, referral_base, wait_times
from ..sources.tables import literal_rows
from .base import query, session_run, shared, shared_key, table
from .domain import ORGS_SQL, activity_tables, hierarchy

RUN = datetime(2024, 6, 1, 9, 0)
CUT = date(1998, 1, 1)
LINE_CODES = {1: "F067", 2: "F000", 3: "F03X", 4: "28E0."}


def _text(prefix, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def _record(order_key, month):
    """Number of the record of an order in a month."""
    return order_key * 1000 + (F.year(month) - 1990) * 12 + F.month(month)


def pathway_tables(spark, folder, keep=None) -> dict[str, DataFrame]:
    """The tables of the pathway. keep(name, df) may store what several tables come from."""
    lines = table(
        spark, folder, "lineitem",
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    order, person = F.col("l_orderkey"), _text("p", F.col("o_custkey"))
    day, month = as_date("l_shipdate"), month_start("l_shipdate")
    # The last day of an order, and the lines that stand for a month of it, while its lines are together.
    nth_of_month = F.row_number().over(W.partitionBy("l_orderkey", "Month").orderBy("l_linenumber"))
    discharged = F.max(F.when(F.col("l_returnflag") == "N", day)).over(W.partitionBy("l_orderkey"))
    dealt = (
        lines.select("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")
        .repartition("l_orderkey")
        .withColumn("Month", month)
        .withColumn("__reported", nth_of_month == 1)
        .withColumn("ServDischDate", discharged)
    )
    # A customer's rows are numbered: what is not about customers takes a record once.
    numbered = customers.withColumn(
        "__nth", F.row_number().over(W.partitionBy("c_custkey").orderBy("c_nationkey", "c_mktsegment"))
    )
    placed = (
        orders.join(numbered, F.col("o_custkey") == F.col("c_custkey"), "left")
        .withColumn("__known", F.col("c_custkey").isNotNull())
        .drop("c_custkey")
    )
    built = dealt.join(placed, order == F.col("o_orderkey")).drop("l_orderkey")
    once = F.coalesce("__nth", F.lit(1)) == 1
    if keep is None:
        seen = lines.join(orders.select("o_orderkey", "o_custkey"), order == F.col("o_orderkey"))
    else:  # rows of a month side by side move in less space
        built = keep("records", built.sortWithinPartitions("Month", "o_orderpriority", "c_nationkey", "c_mktsegment"))
        seen = built.where(once)
    seen = seen.withColumns({"UniqServReqID": _text("r", F.col("o_orderkey")), "Der_Person_ID": person})
    recorded = built.where("__reported").withColumn("RecordNumber", _record(F.col("o_orderkey"), F.col("Month")))
    records = recorded.where("__known")
    served = recorded.where((F.col("o_orderkey") % 7 != 0) & once)
    diagnosed = seen.where(F.col("l_returnflag") != "N").select(
        "Der_Person_ID",
        "UniqServReqID",
        F.coalesce(recode("l_linenumber", LINE_CODES), F.lit("Z99")).alias("PrimDiag"),
        F.col("l_shipdate").alias("CodedDiagTimestamp"),
    )
    months = lines.select(month.alias("Month")).distinct()
    months = months if keep is None else keep("reported-months", months)
    reports = months.select(
        F.concat(F.lit("s"), F.date_format("Month", "yyyyMM")).alias("NHSEUniqSubmissionID"),
        F.lit("Y").alias("Der_IsLatest"),
        F.col("Month").alias("ReportingPeriodStartDate"),
        month_end("Month").alias("ReportingPeriodEndDate"),
    )
    older = reports.withColumn("Der_IsLatest", F.lit("N"))
    key = F.col("o_orderkey")
    activity = activity_tables(spark, folder)
    named = "Main_Code_Text string, Main_Description string, Is_Latest int"
    return {
        "referral": records.select(
            "RecordNumber",
            _text("r", key).alias("UniqServReqID"),
            F.when(F.col("Month") < F.lit(CUT), _text("x", F.col("o_custkey")))
            .otherwise(person).alias("Person_ID"),
            person.alias("Der_Person_ID"),
            F.concat(F.lit("s"), F.date_format("Month", "yyyyMM")).alias("NHSEUniqSubmissionID"),
            _text("C", F.col("c_nationkey")).alias("OrgIDComm"),
            _text("P", key % 130).alias("OrgIDProv"),
            as_date("o_orderdate").alias("ReferralRequestReceivedDate"),
            "ServDischDate",
            F.month("Month").alias("UniqMonthID"),
            (F.col("o_custkey") % 60 + 40).cast("int").alias("AgeServReferRecDate"),
            F.substring("o_orderpriority", 1, 1).alias("PrimReasonReferralMH"),
        ),
        "patient_index": records.select(
            "RecordNumber",
            F.substring("c_mktsegment", 1, 1).alias("EthnicCategory"),
            (key % 3).cast("string").alias("Gender"),
        ),
        "care_plan": lines.where("l_returnflag = 'R'").select(
            _record(order, month).alias("RecordNumber"),
            F.when(
                F.col("l_linenumber") != 5, F.date_add(day, (F.col("l_linenumber") % 3) * 20)
            ).alias("CarePlanCreatDate"),
        ),
        "service_type": served.select(
            _text("r", key).alias("UniqServReqID"),
            "RecordNumber",
            person.alias("Der_Person_ID"),
            F.when(key % 3 < 2, "A18").otherwise("XX").alias("ServTeamTypeRefToMH"),
        ),
        "submission_flags": reports.unionByName(older),
        "care_contact": seen.select(
            "UniqServReqID",
            "Der_Person_ID",
            day.alias("CareContDate"),
            recode("l_returnflag", {"A": "5", "R": "6"}, "7").alias("AttendOrDNACode"),
            F.when(F.col("l_linestatus") == "F", "01").otherwise("99").alias("ConsMechanismMH"),
        ),
        "primary_diagnosis": diagnosed,
        "secondary_diagnosis": diagnosed.withColumnRenamed("PrimDiag", "SecDiag"),
        "team_type": literal_rows(
            spark, [("A18", "Old name", 0), ("A18", "Memory Services/Clinic/Drop in service", 1)], named
        ),
        "referral_reason": literal_rows(
            spark, [("1", "Organic brain disorder", 1), ("2", "Organic brain disorder", 1), ("3", "Other reason", 1)],
            named,
        ),
        "commissioner_hierarchy": hierarchy(spark, folder),
        **{
            k: activity[k]
            for k in ("commissioner_code_changes", "provider_successor", "provider_hierarchy")
        },
    }


PATHWAY_SQL = f"""
{ORGS_SQL},
changes(old_code, new_code) AS (VALUES ('C2', 'C7'), ('C3', 'C4'), ('C4', 'C9')),
successors(old_code, new_code) AS (VALUES ('P1', 'P2'), ('P99', 'P0')),
hospitals AS (
  SELECT 'P' || s_suppkey AS code, s_name AS name, r_name AS region_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey <> 7),
lines AS (
  SELECT l.*, CAST(l_shipdate AS DATE) AS day, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
         o_orderdate, o_orderpriority, o_custkey
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
recs AS (
  SELECT l_orderkey AS k, m, last_day(m) AS e, CAST(MIN(o_orderdate) AS DATE) AS received,
         MIN(o_orderpriority)[1:1] AS reason, MIN(o_custkey) AS cust FROM lines GROUP BY k, m),
discharged AS (SELECT l_orderkey AS k, MAX(day) AS left_on FROM lines WHERE l_returnflag = 'N' GROUP BY 1),
contacts AS (
  SELECT l_orderkey AS k, MIN(day) AS first_contact FROM lines
  WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' GROUP BY 1),
plans AS (
  SELECT l_orderkey AS k, m, CASE WHEN l_linenumber <> 5
                                  THEN CAST(day + (l_linenumber % 3) * 20 AS DATE) END AS plan
  FROM lines WHERE l_returnflag = 'R'),
diag AS (
  SELECT DISTINCT l_orderkey AS k, l_shipdate AS ts,
         CASE l_linenumber WHEN 1 THEN 'F067' WHEN 2 THEN 'F000' WHEN 3 THEN 'F03X' ELSE '28E0.' END AS code,
         CASE WHEN l_linenumber IN (1, 4) THEN 'MCI' ELSE 'Condition' END AS area
  FROM lines WHERE l_returnflag <> 'N' AND l_linenumber <= 4),
first_diag AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k
               ORDER BY ts, area DESC, code) AS rn FROM diag) WHERE rn = 1),
last_diag AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k
              ORDER BY ts DESC, area, code DESC) AS rn FROM diag) WHERE rn = 1),
base AS (
  SELECT DISTINCT r.m, r.e, r.k, received, CAST(f.ts AS DATE) AS first_day, left_on, first_contact,
         COALESCE(c.code, 'Other') AS sub, COALESCE(c.name, 'Other') AS sub_name,
         COALESCE(c.stp_code, 'Other') AS icb, COALESCE(c.stp_name, 'Other') AS icb_name,
         COALESCE(c.region_name, 'Other') AS comm_region, COALESCE(h.code, 'Other') AS prov,
         COALESCE(h.name, 'Other') AS prov_name, COALESCE(h.region_name, 'Other') AS prov_region,
         cust % 60 + 40 AS age, substr(c_mktsegment, 1, 1) AS ethnic, CAST(r.k % 3 AS VARCHAR) AS sex,
         CASE WHEN r.k % 7 <> 0 AND r.k % 3 < 2 THEN 'Memory Services/Clinic/Drop in service'
              ELSE 'Missing/invalid' END AS team,
         CASE WHEN reason IN ('1', '2') THEN 'Organic brain disorder' WHEN reason = '3'
              THEN 'Other reason' ELSE 'Missing/invalid' END AS prim,
         CASE WHEN first_contact >= received AND first_contact <= e
              THEN date_diff('day', received, first_contact) END AS wait_contact,
         CASE WHEN CAST(f.ts AS DATE) >= received AND CAST(f.ts AS DATE) <= e
              THEN date_diff('day', received, CAST(f.ts AS DATE)) END AS wait_diag,
         CASE WHEN received BETWEEN r.m AND e THEN 1 ELSE 0 END AS is_new,
         CASE WHEN left_on BETWEEN r.m AND e THEN 1 ELSE 0 END AS is_left,
         CASE WHEN left_on IS NULL OR left_on > e THEN 1 ELSE 0 END AS is_open,
         CASE WHEN (left_on IS NULL OR left_on > e) AND (first_contact IS NULL OR first_contact > e)
              THEN 1 ELSE 0 END AS is_waiting,
         CASE WHEN (left_on IS NULL OR left_on > e) AND plan <= e THEN 1 ELSE 0 END AS has_plan,
         f.code AS first_code, f.area AS first_area, l.code AS last_code, l.area AS last_area
  FROM recs r JOIN customer ON cust = c_custkey
  LEFT JOIN discharged d ON r.k = d.k LEFT JOIN contacts t ON r.k = t.k
  LEFT JOIN plans p ON r.k = p.k AND r.m = p.m
  LEFT JOIN first_diag f ON r.k = f.k AND r.k % 7 <> 0
  LEFT JOIN last_diag l ON r.k = l.k AND r.k % 7 <> 0
  LEFT JOIN changes x ON 'C' || c_nationkey = x.old_code
  LEFT JOIN hier c ON COALESCE(x.new_code, 'C' || c_nationkey) = c.code
  LEFT JOIN successors s ON 'P' || (r.k % 130) = s.old_code
  LEFT JOIN hospitals h ON COALESCE(s.new_code, 'P' || (r.k % 130)) = h.code
)
"""


INPUTS = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def months_of(spark, folder):
    return month_bounds(table(spark, folder, "lineitem", "l_shipdate"), "l_shipdate")


def stored_tables(spark, folder) -> dict[str, DataFrame]:
    """The tables of the pathway; joins and months that they come from are written once."""
    return pathway_tables(spark, folder, lambda name, df: shared(spark, folder, name, INPUTS, lambda: df))


def base(spark, folder):
    """The referral base, built once for all queries that read it."""
    return shared(
        spark, folder, "referral-base", INPUTS,
        lambda: laid_out(
            referral_base(stored_tables(spark, folder), months_of(spark, folder), person_id_from=CUT)
        ),
    )


WAITS = {
    "ContactUnder6weeksNumber": "wait_contact <= 42",
    "Contact6to18weeksNumber": "wait_contact > 42 AND wait_contact <= 126",
    "ContactOver18weeksNumber": "wait_contact > 126",
    "TotalReferralsWithContact": "wait_contact IS NOT NULL",
    "DiagUnder6weeksNumber": "wait_diag <= 42",
    "Diag6to18weeksNumber": "wait_diag > 42 AND wait_diag <= 126",
    "DiagOver18weeksNumber": "wait_diag > 126",
    "TotalReferralsWithDiag": "wait_diag IS NOT NULL",
}


@query(
    "wait_times_dashboard",
    f"""
WITH {PATHWAY_SQL}
SELECT m AS "Month", icb_name AS "ICB_Name", first_area AS "EarliestDiagnosisArea",
       CASE WHEN first_code IS NOT NULL THEN '1' ELSE '0' END AS "ConditionDiagnosis", COUNT(*) AS n,
       CAST(SUM(has_plan) AS BIGINT) AS plans,
       {", ".join(f'COUNT(*) FILTER (WHERE {w}) AS "{n}"' for n, w in WAITS.items())}
FROM base WHERE team = 'Memory Services/Clinic/Drop in service' AND prim = 'Organic brain disorder'
GROUP BY 1, 2, 3, 4
""",
)
def wait_times_dashboard(spark, folder):
    waits = wait_times(base(spark, folder), RUN)
    return waits.groupBy("Month", "ICB_Name", "EarliestDiagnosisArea", "ConditionDiagnosis").agg(
        F.count("*").alias("n"),
        F.sum("RefwithCarePlanCreated").alias("plans"),
        *[F.sum(w).alias(w) for w in WAITS],
    )


SUMS = {
    "NewReferrals": "is_new",
    "OpenReferrals": "is_open",
    "Discharges": "is_left",
    "OpenWaitingFirstCont": "is_waiting",
    "OpenRefwithCarePlanCreated": "has_plan",
}


def _metrics_sql() -> str:
    places = {
        "Provider": "prov AS c, prov_name AS o, prov_region AS r",
        "Sub-ICB": "sub AS c, sub_name AS o, comm_region AS r",
        "ICB": "icb AS c, icb_name AS o, comm_region AS r",
        "National": "'England' AS c, 'England' AS o, 'All Regions' AS r",
    }
    kinds = {
        "Total": "'Total'",
        "Age Group": "CASE WHEN age < 65 THEN 'Under65' WHEN age BETWEEN 65 AND 74 THEN '65to74' "
        "WHEN age BETWEEN 75 AND 84 THEN '75to84' WHEN age >= 85 THEN '85+' ELSE 'Unknown/Not Stated' END",
        "Gender": "CASE sex WHEN '1' THEN 'Males' WHEN '2' THEN 'Females' "
        "ELSE 'Other/Not Stated/Not Known' END",
        "Ethnicity": "CASE WHEN ethnic IN ('A', 'B', 'C') THEN 'White' WHEN ethnic IN ('D', 'E', 'F', 'G') "
        "THEN 'Mixed' WHEN ethnic IN ('H', 'J', 'K', 'L') THEN 'Asian' WHEN ethnic IN ('M', 'N', 'P') "
        "THEN 'Black' WHEN ethnic IN ('R', 'S') THEN 'Other' ELSE 'Not Stated/Not Known' END",
    }
    sums = ", ".join(f'SUM({c}) AS "{n}"' for n, c in SUMS.items())
    return " UNION ALL ".join(
        f"SELECT m, '{t}' AS t, {cols}, team, prim, '{k}' AS cat, {v} AS var, last_code, last_area, {sums} "
        "FROM base GROUP BY ALL"
        for t, cols in places.items()
        for k, v in kinds.items()
    )


@query(
    "referral_metrics_dashboard",
    f"""
WITH {PATHWAY_SQL}, metrics AS ({_metrics_sql()})
SELECT t AS "Orgtype", r AS "Region", cat AS "Category", var AS "Variable", team AS "TeamType",
       last_area AS "LatestDiagnosisArea", COUNT(*) AS n_rows, COUNT(DISTINCT c) AS n_orgs,
       COUNT(last_code) AS n_coded,
       {", ".join(f'CAST(SUM("{n}") AS BIGINT) AS "{n}"' for n in SUMS)}
FROM metrics GROUP BY 1, 2, 3, 4, 5, 6
""",
)
def referral_metrics_dashboard(spark, folder):
    """The metrics table, summed up over months and organisations for comparison."""
    metrics = main_metrics(base(spark, folder), RUN, stored=True)
    keys = ["Orgtype", "Region", "Category", "Variable", "TeamType", "LatestDiagnosisArea"]
    per_org = metrics.groupBy(*keys, "OrgCode").agg(
        F.count("*").alias("n"),
        F.count("Condition Diagnosis Code").alias("k"),
        *[F.sum(s).alias(s) for s in SUMS],
    )
    return per_org.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_orgs"),
        F.sum("k").alias("n_coded"),
        *[F.sum(s).alias(s) for s in SUMS],
    )


@query(
    "referral_metrics_table",
    f"""
WITH {PATHWAY_SQL}, metrics AS ({_metrics_sql()})
SELECT m AS "Month", t AS "Orgtype", c AS "OrgCode", o AS "OrgName", r AS "Region", cat AS "Category",
       var AS "Variable", team AS "TeamType", prim AS "PrimReason", last_code AS "Condition Diagnosis Code",
       last_area AS "LatestDiagnosisArea", CAST(last_code IS NOT NULL AS INTEGER) AS "ConditionDiagnosis",
       {", ".join(f'CAST("{n}" AS BIGINT) AS "{n}"' for n in SUMS)},
       'R' AS "DataSubmissionType", TIMESTAMP '2024-06-01 09:00:00' AS "SnapshotDate"
FROM metrics
""",
)
def referral_metrics_table(spark, folder):
    """The metrics table, row by row."""
    return main_metrics(base(spark, folder), RUN, stored=True)


ROW = {
    "Month": "m", "UniqServReqID": "'r' || k", "FirstContactDate": "first_contact", "OrgIDComm": "sub",
    "ICB_Code": "icb", "OrgIDProv": "prov", "ReferralRequestReceivedDate": "received", "ServDischDate": "left_on",
    "WaitRefContact": "CAST(wait_contact AS INTEGER)", "WaitRefDiag": "CAST(wait_diag AS INTEGER)",
    "NewRef": "is_new", "OpenRef": "is_open", "DischRef": "is_left", "Refwaiting1stcontact": "is_waiting",
    "RefwithCarePlanCreated": "has_plan",
    "FirstContactDateMonthFlag": "CASE WHEN first_contact BETWEEN m AND e THEN 1 ELSE 0 END",
    "EarliestDiagDateMonthFlag": "CASE WHEN first_day BETWEEN m AND e THEN 1 ELSE 0 END",
    "EarliestConditionDiagnosisCode": "first_code", "EarliestDiagnosisArea": "first_area",
    "LatestConditionDiagnosisCode": "last_code", "LatestDiagnosisArea": "last_area",
    "RefToEarliestDiagOrder": "CASE WHEN first_day >= received THEN 'Diagnosis After Referral' "
    "WHEN first_day < received THEN 'Diagnosis Before Referral' ELSE 'No Diagnosis' END",
    **{n: f"CASE WHEN {w} THEN 1 ELSE 0 END" for n, w in WAITS.items()},
}


ROW_SQL = f"""
WITH {PATHWAY_SQL}
SELECT {", ".join(f'{c} AS "{n}"' for n, c in ROW.items())}
FROM base WHERE team = 'Memory Services/Clinic/Drop in service' AND prim = 'Organic brain disorder'
"""


@query("wait_times_table", ROW_SQL)
def wait_times_table(spark, folder):
    """The waits table, row by row, without the columns that are only copied through."""
    return wait_times(base(spark, folder), RUN).select(*ROW)


@query("wait_times_bucketed", ROW_SQL)
def wait_times_bucketed(spark, folder):
    """The same from inputs in buckets by record and by referral."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    built = bucketed_base(
        stored_tables(spark, folder), months_of(spark, folder), session_run(spark), buckets, person_id_from=CUT
    )
    return wait_times(built, RUN).select(*ROW)


@query(
    "pathway_outputs",
    f"""
WITH {PATHWAY_SQL}, metrics AS ({_metrics_sql()})
SELECT 'waits' AS output, m AS "Month", COUNT(*) AS n, CAST(SUM(is_open) AS BIGINT) AS "OpenReferrals",
       CAST(SUM(has_plan) AS BIGINT) AS "OpenRefwithCarePlanCreated",
       COUNT(DISTINCT (team, prim, sub_name, icb_name, prov_name, sex, ethnic)) AS n_labels
FROM base WHERE team = 'Memory Services/Clinic/Drop in service' AND prim = 'Organic brain disorder' GROUP BY 2
UNION ALL
SELECT 'metrics', m, COUNT(*), CAST(SUM("OpenReferrals") AS BIGINT), CAST(SUM("OpenRefwithCarePlanCreated") AS BIGINT),
       COUNT(DISTINCT (team, prim, t, c, o, cat, var)) FROM metrics GROUP BY 2
""",
)
def pathway_outputs_query(spark, folder):
    """Waits and metrics of one run, summed up by month; labels are counted by what tells them apart."""
    tables, months = stored_tables(spark, folder), months_of(spark, folder)
    key = shared_key(spark, folder, "referral-base", INPUTS)
    waits, metrics = pathway_outputs(tables, months, RUN, session_run(spark), key, person_id_from=CUT)
    sums = ["OpenReferrals", "OpenRefwithCarePlanCreated"]

    def summed(name, df, labels):
        return df.groupBy(F.lit(name).alias("output"), "Month").agg(
            F.count("*").alias("n"),
            *[F.sum(s).alias(s) for s in sums],
            F.count_distinct(F.struct(*labels)).alias("n_labels"),
        )

    return summed(
        "waits",
        waits.withColumnsRenamed({"OpenRef": sums[0], "RefwithCarePlanCreated": sums[1]}),
        ["TeamType", "PrimReason", "Sub_ICB_Name", "ICB_Name", "Provider_Name", "Gender", "EthnicCategory"],
    ).unionByName(
        summed("metrics", metrics, ["TeamType", "PrimReason", "Orgtype", "OrgCode", "OrgName", "Category", "Variable"])
    )


AGES = ["Aged 50 to 64 years", "Aged 65 to 74 years", "Aged 75 to 84 years", "Aged 85 years and over"]
CENSUS = date(2021, 3, 21)


def population_tables(spark, folder) -> dict[str, DataFrame]:
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    areas = customers.select(
        F.concat(F.lit("E01_"), nation, F.lit("_"), (key % 20).cast("string")).alias("lsoa21"),
        # Half of these areas lie across two nations.
        F.concat(F.lit("E02_"), (F.col("c_nationkey") % 12).cast("string"), F.lit("_"),
                 (key % 4).cast("string")).alias("msoa21"),
        F.concat(F.lit("E3_"), nation).alias("ccg"),
        F.element_at(F.array(*[F.lit(a) for a in AGES]), (key % 4 + 1).cast("int")).alias("age"),
        F.when(key % 3 == 0, "Female").when(key % 3 == 1, "Male").otherwise("All persons").alias("Sex"),
        F.when(F.col("c_mktsegment") < "F", "Ethnic_group:_White")
        .when(F.col("c_mktsegment") < "M", "Ethnic_group:_Other_ethnic_group")
        .otherwise("Ethnic_group:_White:_English").alias("Measure"),
    )

    def count(area, what, kind):
        return areas.groupBy(F.col(area).alias("Geography_Code"), what).agg(
            F.count("*").alias("Count")
        ).withColumns({"Geography_Type": F.lit(kind), "Effective_Snapshot_Date": F.lit(CENSUS)})

    codes = table(spark, folder, "nation").select(
        _text("C", F.col("n_nationkey")).alias("CCG_Code"),
        _text("E3_", F.col("n_nationkey")).alias("CCG_Code2"),
    )
    hier = hierarchy(spark, folder).where(F.col("Effective_To").isNull())
    out = {
        "ccg_names_scd": codes,
        "postcode_lookup": areas,
        "commissioner_hierarchy": hier,
        "census_age": count("msoa21", "age", "msoa").withColumnRenamed("age", "Measure_Name"),
        "census_sex": count("lsoa21", "Sex", "lsoa"),
        "census_ethnicity": count("lsoa21", "Measure", "lsoa").select(
            "*", (F.col("Count") * 0.5).alias("Measure_Value")
        ),
    }
    out["area_lookup"] = area_lookup(out)
    return out


POPULATION_SQL = f"""
{ORGS_SQL},
people AS (
  SELECT 'E01_' || c_nationkey || '_' || (c_custkey % 20) AS lsoa,
         'E02_' || (c_nationkey % 12) || '_' || (c_custkey % 4) AS msoa, 'C' || c_nationkey AS sub,
         CASE c_custkey % 4 WHEN 0 THEN 'Under65' WHEN 1 THEN '65to74' WHEN 2 THEN '75to84' ELSE '85+' END AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'Females' WHEN 1 THEN 'Males' END AS sex,
         CASE WHEN c_mktsegment < 'F' THEN 'White' WHEN c_mktsegment < 'M' THEN 'Other' END AS ethnic
  FROM customer),
counted AS (
  SELECT 'Age Group' AS cat, msoa AS area, age AS var, CAST(COUNT(*) AS DOUBLE) AS n FROM people GROUP BY ALL
  UNION ALL
  SELECT 'Gender', lsoa, sex, COUNT(*) FROM people WHERE sex IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'Ethnicity', lsoa, ethnic, COUNT(*) * 0.5 FROM people WHERE ethnic IS NOT NULL GROUP BY ALL),
placed AS (
  SELECT c.*, h.* FROM counted c
  JOIN (SELECT DISTINCT msoa AS a, sub FROM people UNION SELECT DISTINCT lsoa, sub FROM people) ON area = a
  JOIN hier h ON sub = h.code),
pops AS (
  SELECT 'Sub-ICB' AS t, name AS o, code AS c, cat, var, SUM(n) AS pop FROM placed GROUP BY ALL
  UNION ALL SELECT 'ICB', stp_name, stp_code, cat, var, SUM(n) FROM placed GROUP BY ALL
  UNION ALL SELECT 'National', 'England', 'England', cat, var, SUM(n) FROM placed GROUP BY ALL)
"""


@query(
    "population_dashboard",
    f"""
WITH {POPULATION_SQL}
SELECT t AS "Org_Type", o AS "Org_Name", c AS "Org_Code", cat AS "Category", var AS "Variable",
       CASE WHEN cat = 'Ethnicity' THEN ROUND(pop) ELSE pop END AS "Pop"
FROM pops
""",
)
def population_dashboard(spark, folder):
    return population_table(population_tables(spark, folder), staged=True)


@query(
    "open_referral_rate_dashboard",
    f"""
WITH {PATHWAY_SQL}, metrics AS ({_metrics_sql()}), {POPULATION_SQL.replace(ORGS_SQL + ",", "")}
SELECT x.m AS "Month", x.t AS "Orgtype", x.c AS "OrgCode", x.cat AS "Category", x.var AS "Variable",
       x.n AS "OpenReferrals", CAST(p.pop AS DOUBLE) AS "Pop",
       x.n * CAST(100000 AS DOUBLE) / p.pop AS "OpenReferralsPer100k"
FROM (SELECT m, t, c, cat, var, CAST(SUM("OpenReferrals") AS BIGINT) AS n FROM metrics GROUP BY ALL) x
LEFT JOIN (SELECT t, c, cat, var, CASE WHEN cat = 'Ethnicity' THEN ROUND(pop) ELSE pop END AS pop FROM pops) p
  ON x.t = p.t AND x.c = p.c AND x.cat = p.cat AND x.var = p.var
""",
)
def open_referral_rate_dashboard(spark, folder):
    metrics = main_metrics(base(spark, folder), RUN, stored=True)
    return open_referral_rates(metrics, population_dashboard(spark, folder))
