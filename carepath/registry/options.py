"""Options of the jobs, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.population import population_table
from ..plans.referral_pathway import diagnosis_cohort, ranked_diagnoses, referral_base
from .base import query
from .care import CUT, PATHWAY_SQL, POPULATION_SQL, months_of, pathway_tables, population_tables, stored_tables

BOTH = "SELECT DISTINCT msoa AS a, sub FROM people UNION SELECT DISTINCT lsoa, sub FROM people"


@query(
    "population_first_area",
    f"""
WITH {POPULATION_SQL.replace(f"({BOTH})", f"(SELECT a, MIN(sub) AS sub FROM ({BOTH}) GROUP BY a)")}
SELECT t AS "Org_Type", o AS "Org_Name", c AS "Org_Code", cat AS "Category", var AS "Variable",
       CASE WHEN cat = 'Ethnicity' THEN ROUND(pop) ELSE pop END AS "Pop"
FROM pops
""",
)
def population_first_area(spark, folder):
    """Areas on a border count in one organisation."""
    return population_table(population_tables(spark, folder), assign="first", staged=True)


@query(
    "referrals_one_row",
    f"""
WITH {PATHWAY_SQL}
SELECT m AS "Month", icb AS "ICB_Code", prim AS "PrimReason", COUNT(*) AS n, CAST(SUM(plan) AS BIGINT) AS plans
FROM (SELECT * EXCLUDE (has_plan), MAX(has_plan) AS plan FROM base GROUP BY ALL)
GROUP BY 1, 2, 3
""",
)
def referrals_one_row(spark, folder):
    """Referrals with care plans on both sides of the period end give one row."""
    rows = referral_base(
        stored_tables(spark, folder), months_of(spark, folder), one_row_per_referral=True, person_id_from=CUT
    )
    return rows.groupBy("Month", "ICB_Code", "PrimReason").agg(
        F.count("*").alias("n"), F.sum("RefwithCarePlanCreated").alias("plans")
    )


# Summer time of London goes from the last Sunday of March to the last one of
# October, until 1995 to the first Sunday from 22 October on; it changes at one o'clock UTC.
SPRING = "last_day(make_date(year(ts), 3, 1))"
AUTUMN = "CASE WHEN year(ts) <= 1995 THEN make_date(year(ts), 10, 28) ELSE make_date(year(ts), 10, 31) END"


def _clock_change(last: str) -> str:
    """The last Sunday up to a day, at one o'clock."""
    return f"CAST(({last}) - CAST(dayofweek({last}) AS INTEGER) AS TIMESTAMP) + INTERVAL 1 HOUR"


@query(
    "cohort_local_secondary",
    f"""
WITH {PATHWAY_SQL},
late AS (SELECT DISTINCT k, CAST(ts AS TIMESTAMP) + INTERVAL 1410 MINUTE AS ts, code, area FROM diag),
local AS (
  SELECT k, code, area, ts + CASE WHEN ts >= {_clock_change(SPRING)} AND ts < {_clock_change(AUTUMN)}
                                  THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ts FROM late),
cohort AS (
  SELECT * FROM local x WHERE code <> 'F03X'
     OR NOT EXISTS (SELECT 1 FROM local p WHERE p.k = x.k AND p.ts = x.ts AND p.code <> 'F03X')),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY ts, area DESC, code) AS early,
         ROW_NUMBER() OVER (PARTITION BY k ORDER BY ts DESC, area, code DESC) AS late FROM cohort)
SELECT CAST(e.ts AS DATE) AS day, e.code AS first_code, l.code AS last_code, COUNT(*) AS n,
       MIN(e.ts) AS first_time, MAX(l.ts) AS last_time
FROM ranked e JOIN ranked l ON e.k = l.k AND e.early = 1 AND l.late = 1
GROUP BY 1, 2, 3
""",
)
def cohort_local_secondary(spark, folder):
    """Diagnoses late in the evening, by the clock of London, with those that are secondary only."""
    tables = pathway_tables(spark, folder)
    late = F.expr("CAST(CodedDiagTimestamp AS timestamp_ntz) + INTERVAL '23:30' HOUR TO MINUTE")
    primary = tables["primary_diagnosis"].where(F.col("PrimDiag") != "F03X")
    shifted = {
        "primary_diagnosis": primary.withColumn("CodedDiagTimestamp", late),
        "secondary_diagnosis": tables["secondary_diagnosis"].withColumn("CodedDiagTimestamp", late),
    }
    ranked = ranked_diagnoses(
        diagnosis_cohort({**tables, **shifted}, tz="Europe/London", include_secondary_only=True)
    )
    return ranked.groupBy(
        F.col("EarliestCodedDiagTimestamp").cast("date").alias("day"),
        F.col("EarliestDiagnosisCode").alias("first_code"),
        F.col("LatestDiagnosisCode").alias("last_code"),
    ).agg(
        F.count("*").alias("n"),
        F.min("EarliestCodedDiagTimestamp").alias("first_time"),
        F.max("LatestCodedDiagTimestamp").alias("last_time"),
    )
