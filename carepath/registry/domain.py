"""The domain tables of the jobs, derived from the given tables.

A nation is a Sub-ICB, a pair of nations of one region an ICB, a supplier a hospital;
orders are monthly measures, spells and episodes. Each table has its twin in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.labels import recode
from ..sources.tables import literal_rows
from .base import NATION_MONTH_SQL, orders_per_nation_month, table

ERA = date(1998, 1, 1)
CCG = "CLINICAL COMMISSIONING GROUP"
CODE_CHANGES = [("C2", "C7"), ("C3", "C4"), ("C4", "C9")]
SUCCESSORS = [("P1", "P2"), ("P99", "P0")]
SPLITS = [
    ("C0", "NATION_0", 0.18204175443292, "C5", "NATION_5", "SX", "ICB X", "RX", "South East"),
    ("C0", "NATION_0", 0.229339252148803, "C10", "NATION_10", "SY", "ICB Y", "RX", "South East"),
    ("C0", "NATION_0", 0.588618993418278, "C15", "NATION_15", "SZ", "ICB Z", "RX", "South East"),
]
DIAGNOSES = {"F": "||F03X,Z9", "O": "||Z1,F050", "P": "||F067"}
TITLES = [("F", "F03", "Condition", "V", "Mental"), ("O", "F05", None, "V", "Mental")]


def hierarchy(spark, folder) -> DataFrame:
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key, region = F.col("n_nationkey"), F.col("n_regionkey").cast("string")
    pair = F.concat(region, F.lit("_"), (key % 2).cast("string"))
    now = nation.select(
        F.concat(F.lit("C"), key.cast("string")).alias("Organisation_Code"),
        F.col("n_name").alias("Organisation_Name"),
        F.concat(F.lit("S"), pair).alias("STP_Code"),
        F.concat(F.lit("ICB "), pair).alias("STP_Name"),
        F.concat(F.lit("R"), region).alias("Region_Code"),
        F.col("r_name").alias("Region_Name"),
        F.lit(None).cast("date").alias("Effective_To"),
        F.when(key == 21, "COMMISSIONING HUB").otherwise(CCG).alias("NHSE_Organisation_Type"),
    )
    closed = now.withColumns(
        {
            "Organisation_Name": F.concat("Organisation_Name", F.lit(" (old)")),
            "Effective_To": F.lit(date(2019, 3, 31)),
        }
    )
    return now.unionByName(closed)


def activity_hierarchy(spark, folder) -> DataFrame:
    """Rows in force, some of which are no reporting organisation."""
    code = F.col("Organisation_Code")
    return (
        hierarchy(spark, folder)
        .where(F.col("Effective_To").isNull())
        .withColumns(
            {
                "Organisation_Name": F.when(code == "C24", "REPORTING ENTITY 24").otherwise(
                    F.col("Organisation_Name")
                ),
                "STP_Name": F.when(code == "C23", "NonSTP (Wales Region)").when(
                    code != "C22", F.col("STP_Name")
                ),
            }
        )
    )


def ccg_lookup(spark, folder) -> DataFrame:
    """C1 went into C5, and C6 is missing."""
    key = F.col("n_nationkey").cast("string")
    return (
        table(spark, folder, "nation")
        .where(F.col("n_nationkey") != 6)
        .select(
            F.concat(F.lit("C"), key).alias("IC_CCG"),
            F.when(F.col("n_nationkey") == 1, "C5").otherwise(F.concat(F.lit("C"), key)).alias("CCG21"),
        )
    )


ORGS_SQL = f"""
hier AS (
  SELECT 'C' || n_nationkey AS code, n_name AS name,
         'S' || n_regionkey || '_' || (n_nationkey % 2) AS stp_code,
         'ICB ' || n_regionkey || '_' || (n_nationkey % 2) AS stp_name,
         'R' || n_regionkey AS region_code, r_name AS region_name,
         CASE WHEN n_nationkey = 21 THEN 'COMMISSIONING HUB' ELSE '{CCG}' END AS kind
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ccg_lookup AS (
  SELECT 'C' || n_nationkey AS old_code,
         CASE n_nationkey WHEN 1 THEN 'C5' ELSE 'C' || n_nationkey END AS new_code
  FROM nation WHERE n_nationkey <> 6)
"""

POINTS_SQL = f"""
{NATION_MONTH_SQL}, {ORGS_SQL},
placed AS (
  SELECT "Month" AS day, h.*, n, n_f, n_p FROM nation_month
  LEFT JOIN ccg_lookup ON 'C' || n_nationkey = old_code
  LEFT JOIN hier h ON new_code = h.code AND kind = '{CCG}'),
points AS (
  SELECT day, 'Sub-ICB' AS t, name AS o, code AS c, stp_name AS i, CAST(NULL AS VARCHAR) AS r,
         CAST(SUM(n) AS DOUBLE) AS n, CAST(SUM(n_f) AS DOUBLE) AS n_f, CAST(SUM(n_p) AS DOUBLE) AS n_p
  FROM placed GROUP BY ALL
  UNION ALL
  SELECT day, 'ICB', stp_name, stp_code, stp_name, region_name, SUM(n), SUM(n_f), SUM(n_p)
  FROM placed GROUP BY ALL
  UNION ALL
  SELECT day, 'Region', region_name, region_code, NULL, region_name, SUM(n), SUM(n_f), SUM(n_p)
  FROM placed GROUP BY ALL
  UNION ALL
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE), 'National', 'England', 'England', NULL, NULL,
         COUNT(*), COUNT(*) FILTER (WHERE o_orderstatus = 'F'), COUNT(*) FILTER (WHERE o_orderstatus = 'P')
  FROM orders GROUP BY ALL)
"""


def _published(spark, folder) -> DataFrame:
    """Order counts per nation, and per month for the whole, before and after the era."""
    names = ["n", "n_f", "n_p"]
    local = orders_per_nation_month(spark, folder).select(
        F.when(F.col("Month") < F.lit(ERA), "CCG").otherwise("SUB_ICB_LOC").alias("kind"),
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("code"),
        "Month",
        *names,
    )
    status = F.col("o_orderstatus")
    whole = (
        table(spark, folder, "orders")
        .groupBy(F.trunc(as_date("o_orderdate"), "MM").alias("Month"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(status == "F").alias("n_f"),
            F.count_if(status == "P").alias("n_p"),
        )
        .select(F.lit("ALL").alias("kind"), F.lit("ENG").alias("code"), "Month", *names)
    )
    return local.unionByName(whole)


def rate_tables(spark, folder) -> dict[str, DataFrame]:
    long = (
        _published(spark, folder)
        .withColumnsRenamed({"n": "CONDITION_ESTIMATE_65_PLUS", "n_f": "CONDITION_REGISTER_65_PLUS"})
        .unpivot(
            ["kind", "code", "Month"],
            ["CONDITION_ESTIMATE_65_PLUS", "CONDITION_REGISTER_65_PLUS"],
            "Measure",
            "Measure_Value",
        )
        .select(
            recode("kind", {"ALL": "COUNTRY_RESPONSIBILITY"}, F.col("kind")).alias("Org_Type"),
            F.col("code").alias("Org_Code"),
            "Measure",
            "Measure_Value",
            F.col("Month").alias("Effective_Snapshot_Date"),
        )
    )
    return {
        "commissioner_hierarchy": hierarchy(spark, folder),
        "ccg_lookup": ccg_lookup(spark, folder),
        "diagnosis_rate_old": long.where(F.col("Effective_Snapshot_Date") < F.lit(ERA)),
        "diagnosis_rate_new": long.where(F.col("Effective_Snapshot_Date") >= F.lit(ERA)),
    }


def prescribing_tables(spark, folder) -> dict[str, DataFrame]:
    wide = _published(spark, folder).select(
        "Month",
        recode("kind", {"ALL": "National"}, F.col("kind")).alias("Type"),
        F.col("code").alias("Code"),
        F.col("n_f").alias("Without Psychosis Diagnosis"),
        F.col("n_p").alias("With Psychosis Diagnosis"),
        F.col("n").alias("Condition Register"),
    )
    return {
        "commissioner_hierarchy": hierarchy(spark, folder),
        "ccg_lookup": ccg_lookup(spark, folder),
        "antipsychotic_old": wide.where(F.col("Month") < F.lit(ERA)),
        "antipsychotic_new": wide.where(F.col("Month") >= F.lit(ERA)),
    }


def _dictionary(spark, *rows) -> DataFrame:
    return literal_rows(
        spark,
        [(*r, None, None) for r in rows],
        "Main_Code_Text string, Main_Description string, Effective_To date, Valid_From date",
    )


def activity(spark, folder) -> DataFrame:
    """Orders as hospital stays."""
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    key = F.col("o_orderkey")
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("Ident"),
            F.col("o_custkey").alias("Der_Pseudo_NHS_Number"),
            F.col("o_orderdate").alias("Admission_Date"),
            F.date_add(as_date("o_orderdate"), (key % 30).cast("int")).alias("Discharge_Date"),
            F.col("o_orderdate").alias("Extract_Date_Time"),
            (key % 5).cast("int").alias("Der_Diagnosis_Count"),
            recode("o_orderstatus", DIAGNOSES).alias("Der_Diagnosis_All"),
            (F.col("o_custkey") % 60 + 40).cast("int").alias("age"),
            F.nullif(key % 30, F.lit(29)).cast("int").alias("Der_Spell_LoS"),
            F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("Der_Commissioner_Code"),
            F.concat(F.lit("P"), (key % 130).cast("string")).alias("Der_Provider_Code"),
            F.concat(F.substring("o_orderpriority", 1, 1), F.lit("1")).alias("Admission_Method"),
            F.when(key % 4 == 0, "3").when(key % 4 == 1, "5").otherwise("1").alias(
                "Patient_Classification"
            ),
            F.substring("c_mktsegment", 1, 1).alias("Ethnic_Group"),
            (key % 3).cast("string").alias("Sex"),
            F.col("o_orderstatus").alias("Source_of_Admission"),
            F.col("o_orderstatus").alias("Der_Primary_Diagnosis_Code"),
            F.substring("o_orderpriority", 3, 1).alias("Discharge_Destination"),
            F.lit(1).alias("Episode_Number"),
        )
    )


def activity_tables(spark, folder) -> dict[str, DataFrame]:
    stays = activity(spark, folder)
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    hier = activity_hierarchy(spark, folder)
    return {
        "episode": stays.withColumnsRenamed({"Ident": "APCE_Ident", "age": "Age_on_Admission"}),
        "spell": stays.withColumnsRenamed({"Ident": "APCS_Ident", "age": "Age_At_Start_of_Spell_SUS"}),
        "commissioner_hierarchy": hier,
        "commissioner_code_changes": literal_rows(
            spark, CODE_CHANGES, "Org_Code string, New_Code string"
        ),
        "provider_successor": literal_rows(
            spark, SUCCESSORS, "Prov_original string, Prov_successor string"
        ),
        "provider_hierarchy": suppliers.select(
            F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("Organisation_Code"),
            F.col("s_name").alias("Organisation_Name"),
            F.col("r_name").alias("Region_Name"),
            F.when(F.col("s_suppkey") == 7, F.lit(date(2018, 1, 1))).alias("Effective_To"),
        ),
        "gender": _dictionary(spark, ("1", "Male"), ("2", "Female")),
        "ethnicity": _dictionary(spark, ("A", "Group A"), ("B", "Group B"), ("F", "Group F")),
        "admission_source": _dictionary(spark, ("F", "Home"), ("O", "Hospital")),
        "discharge_destination": _dictionary(spark, ("L", "Home"), ("H", "Hospital")),
        "icd10_titles": literal_rows(
            spark,
            [(*t, None) for t in TITLES],
            "Alt_Code string, Category_2_Code string, Category_2_Description string, "
            "Chapter_Code string, Chapter_Description string, Effective_To date",
        ),
        "subicb_2026": hier.where(F.col("Organisation_Code") != "C0").select(
            F.col("Organisation_Code").alias("Sub_ICB_Location_ODS_Code"),
            F.col("Organisation_Name").alias("Sub_ICB_Location_Name"),
            F.col("STP_Code").alias("ICB_Code"),
            F.concat(F.lit("ICB "), F.col("STP_Code")).alias("Integrated_Care_Board_Name"),
            "Region_Code",
            F.concat("Region_Name", F.lit(" COMMISSIONING REGION")).alias("Region_Name"),
        ),
    }


def splits(spark) -> DataFrame:
    from ..operators.weights import split_rows

    return split_rows(spark, SPLITS)


# Region titles of the data are not among the known seven, so short names are NULL
# except in the split rows; an unmatched Sub-ICB has 'Other'.
ACTIVITY_SQL = f"""
{ORGS_SQL},
act AS (SELECT * FROM hier WHERE code NOT IN ('C22', 'C23', 'C24')),
changes(old_code, new_code) AS (VALUES ('C2', 'C7'), ('C3', 'C4'), ('C4', 'C9')),
successors(old_code, new_code) AS (VALUES ('P1', 'P2'), ('P99', 'P0')),
hospitals AS (
  SELECT 'P' || s_suppkey AS code, s_name AS name, r_name AS region_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey <> 7),
alloc AS (
  SELECT code AS old_code, CAST(1 AS DOUBLE) AS w, code AS sub_code,
         CASE WHEN code = 'C24' THEN 'REPORTING ENTITY 24' ELSE name END AS sub_name, stp_code,
         'ICB ' || stp_code AS stp_name, CAST(NULL AS VARCHAR) AS region_name
  FROM hier WHERE code <> 'C0'
  UNION ALL
  VALUES ('C0', CAST(0.18204175443292 AS DOUBLE), 'C5', 'NATION_5', 'SX', 'ICB X', 'South East'),
         ('C0', CAST(0.229339252148803 AS DOUBLE), 'C10', 'NATION_10', 'SY', 'ICB Y', 'South East'),
         ('C0', CAST(0.588618993418278 AS DOUBLE), 'C15', 'NATION_15', 'SZ', 'ICB Z', 'South East')),
stays AS (
  SELECT o_orderkey AS ident, o_custkey AS person, CAST(o_orderdate AS DATE) AS adm,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS dis,
         o_orderkey % 5 AS n_diag, o_orderstatus AS st,
         CASE WHEN o_custkey % 60 + 40 >= 65 THEN 1 ELSE 0 END AS age65,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS dem,
         CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS del,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS mci,
         NULLIF(o_orderkey % 30, 29) AS los,
         COALESCE(c.code, 'Other') AS sub, COALESCE(h.code, 'Other') AS prov,
         COALESCE(h.name, 'Other') AS prov_name, COALESCE(h.region_name, 'Other') AS prov_region,
         CASE o_orderkey % 4 WHEN 0 THEN '3' WHEN 1 THEN '5' ELSE '1' END AS cls,
         CASE o_orderkey % 3 WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Missing/invalid' END AS gender,
         CASE substr(c_mktsegment, 1, 1) WHEN 'A' THEN 'Group A' WHEN 'B' THEN 'Group B'
              WHEN 'F' THEN 'Group F' ELSE 'Missing/invalid' END AS ethnic,
         CASE o_orderstatus WHEN 'F' THEN 'Home' WHEN 'O' THEN 'Hospital' ELSE 'Missing/invalid' END AS src,
         CASE substr(o_orderpriority, 3, 1) WHEN 'L' THEN 'Home' WHEN 'H' THEN 'Hospital'
              ELSE 'Missing/invalid' END AS dest,
         CASE WHEN o_orderstatus = 'F' THEN 'F03: Condition' END AS diag,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'V: Mental' END AS chapter
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN changes x ON 'C' || c_nationkey = x.old_code
  LEFT JOIN act c ON COALESCE(x.new_code, 'C' || c_nationkey) = c.code
  LEFT JOIN successors s ON 'P' || (o_orderkey % 130) = s.old_code
  LEFT JOIN hospitals h ON COALESCE(s.new_code, 'P' || (o_orderkey % 130)) = h.code
  WHERE o_orderpriority LIKE '2%')
"""
