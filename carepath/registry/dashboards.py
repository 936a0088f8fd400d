"""The six jobs, end to end, on domain tables derived from the given ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.dates import Window, month_bounds, refresh_window, shift_months
from ..functions.disclosure import suppress
from ..plans.admissions import COUNTS, admissions, admissions_counts
from ..plans.diagnosis_rate import diagnosis_rate
from ..plans.prescribing import prescribing
from ..plans.readmissions import readmission_counts, readmissions
from .base import query
from .domain import (
    ACTIVITY_SQL,
    ERA,
    POINTS_SQL,
    activity_tables,
    prescribing_tables,
    rate_tables,
    splits,
)

RUN = datetime(2024, 6, 1, 9, 0)

LIMITS_SQL = """
  p{s} AS pbar{s},
  p{s} + 3 * SQRT(CASE WHEN p{s} <= 1 THEN p{s} * (1 - p{s}) / n END) AS "UCL{s}",
  p{s} - 3 * SQRT(CASE WHEN p{s} <= 1 THEN p{s} * (1 - p{s}) / n END) AS "LCL{s}"
"""


@query(
    "diagnosis_rate_dashboard",
    f"""
WITH {POINTS_SQL},
phased AS (
  SELECT *, CASE WHEN day < DATE '1998-01-01' THEN 1 WHEN day > DATE '1998-01-01' THEN 2 END AS ph
  FROM points WHERE c IS NOT NULL),
whole AS (SELECT t, c, SUM(n_f) / SUM(n) AS p2 FROM phased GROUP BY t, c),
part AS (SELECT t, c, ph, SUM(n_f) / SUM(n) AS p FROM phased WHERE ph IS NOT NULL GROUP BY t, c, ph)
SELECT t AS "Org Type", o AS "Org Name", c AS "Org Code", i AS "ICB Name", r AS "Region Name",
       day AS "Effective_Snapshot_Date", n AS "CONDITION_ESTIMATE_65_PLUS",
       n_f AS "CONDITION_REGISTER_65_PLUS", n_f / n AS "CONDITION_RATE_65_PLUS",
       {LIMITS_SQL.format(s="")}, {LIMITS_SQL.format(s="2")}
FROM phased JOIN whole USING (t, c) JOIN part USING (t, c, ph)
""",
)
def diagnosis_rate_dashboard(spark, folder):
    return diagnosis_rate(rate_tables(spark, folder), split=ERA)


@query(
    "prescribing_dashboard",
    f"""
WITH {POINTS_SQL},
bar AS (SELECT t, c, SUM(n_f) / SUM(n) AS p, SUM(n_p) / SUM(n) AS p2 FROM points GROUP BY t, c)
SELECT t AS "Org Type", o AS "Org Name", c AS "Org Code", i AS "ICB Name", r AS "Region Name",
       day AS "Effective_Snapshot_Date", n_f AS "ANTI_PSY_NO_PSY_DIAG_ALL_AGES",
       n_p AS "ANTI_PSY_PSY_DIAG_ALL_AGES", n AS "DEM_REGISTER",
       n_p / n AS "Proportion_of_DEM_WITH_ANTI_PSY_AND_PSY_DIAG",
       n_f / n AS "Proportion_of_DEM_WITH_ANTI_PSY_AND_NO_PSY_DIAG",
       {LIMITS_SQL.format(s="")}, {LIMITS_SQL.format(s="2")}
FROM points JOIN bar USING (t, c)
UNION ALL
SELECT DISTINCT t, o, c, i, r, CAST(NULL AS DATE), NULL, NULL, NULL, NULL, NULL,
       SUM(n_f) OVER w / SUM(n) OVER w, NULL, NULL, SUM(n_p) OVER w / SUM(n) OVER w, NULL, NULL
FROM points WHERE c IS NULL WINDOW w AS (PARTITION BY t, o, i, r)
""",
)
def prescribing_dashboard(spark, folder):
    return prescribing(prescribing_tables(spark, folder))


NAMES = list(COUNTS)
PLAIN = ["COUNT(*)", "SUM(age65)", "SUM(dem)", "SUM(del)", "SUM(mci)"]


def window(tables) -> Window:
    """Every month with an admission or a discharge."""
    stays = tables["spell"]
    both = stays.select(F.col("Admission_Date").cast("date").alias("d")).unionByName(
        stays.select(F.col("Discharge_Date").cast("date").alias("d"))
    )
    return month_bounds(both, "d")


def _admission_parts():
    """(source filter, month, category, label, variable, chapter) of each breakdown."""
    adm, dis = "date_trunc('month', adm)", "date_trunc('month', dis)"
    inside = "IS NOT NULL"
    parts = [
        (f"adm {inside}", adm, label, value, chapter)
        for label, value, chapter in (
            ("Total", "'Total'", "NULL"),
            ("Gender", "gender", "NULL"),
            ("Ethnicity", "ethnic", "NULL"),
            ("Admission Source", "src", "NULL"),
            ("Primary Diagnosis", "diag", "chapter"),
        )
    ]
    parts.append((f"dis {inside}", dis, "Discharge Destination", "dest", "NULL"))
    los = (
        "CASE WHEN los <= 1 THEN '1 Day or less' WHEN los BETWEEN 2 AND 3 THEN 'Between 2 and 3 Days' "
        "WHEN los BETWEEN 4 AND 10 THEN 'Between 4 and 10 Days' WHEN los BETWEEN 11 AND 21 "
        "THEN 'Between 11 and 21 Days' WHEN los > 21 THEN 'More than 21 Days' END"
    )
    parts.append((f"adm {inside}", adm, "Length of Stay", los, "NULL"))
    return parts


def _admissions_sql() -> str:
    selects = []
    for where, month, label, value, chapter in _admission_parts():
        head = f"CAST({month} AS DATE) AS m"
        tail = f"'{label}' AS cat, {value} AS var, CAST({chapter} AS VARCHAR) AS chap"
        base = f"(SELECT * FROM stays WHERE cls IN ('1', '5') AND {where})"
        sums = ", ".join(f"CAST({e} AS DOUBLE) AS v{i}" for i, e in enumerate(PLAIN))
        selects.append(
            f"SELECT {head}, 'Provider' AS t, prov_region AS r, prov_name AS g, {tail}, {sums} "
            f"FROM {base} GROUP BY m, r, g, prov, cat, var, chap"
        )
        selects.append(
            f"SELECT {head}, 'National' AS t, 'All Regions' AS r, 'England' AS g, {tail}, {sums} "
            f"FROM {base} GROUP BY m, cat, var, chap"
        )
        low = (
            f"(SELECT {head}, sub, {tail}, {sums} FROM {base} GROUP BY m, sub, cat, var, chap) x "
            "LEFT JOIN alloc ON sub = old_code"
        )
        weighted = ", ".join(f"SUM(v{i} * COALESCE(w, 1)) AS v{i}" for i in range(5))
        region = "CASE WHEN w IS NULL THEN 'Other' ELSE COALESCE(region_name, 'Other') END"
        for t, code, name in (("Sub-ICB", "sub_code", "sub_name"), ("ICB", "stp_code", "stp_name")):
            selects.append(
                f"SELECT m, '{t}' AS t, {region} AS r, COALESCE({name}, 'Other') AS g, cat, var, chap, "
                f"{weighted} FROM {low} GROUP BY m, r, g, COALESCE({code}, 'Other'), cat, var, chap"
            )
    return " UNION ALL ".join(selects)


@query(
    "admissions_dashboard",
    f"""
WITH {ACTIVITY_SQL}, counts AS ({_admissions_sql()})
SELECT m AS "Month", t AS "GroupType", r AS "RegionCode", g AS "GeographyName", cat AS "Category",
       var AS "Variable", chap AS "Primary Diagnosis Chapter",
       {", ".join(
           f'''CASE WHEN v{i} < 7 THEN '*' ELSE CAST(CAST(ROUND(v{i}) AS BIGINT) AS VARCHAR) END AS "{n}"'''
           for i, n in enumerate(NAMES))},
       TIMESTAMP '2024-06-01 09:00:00' AS "SnapshotDate"
FROM counts
""",
)
def admissions_dashboard(spark, folder):
    tables = activity_tables(spark, folder)
    return admissions(tables, window(tables), RUN, splits(spark))


@query(
    "admissions_unsuppressed",
    f"""
WITH {ACTIVITY_SQL}, counts AS ({_admissions_sql()})
SELECT t AS "GroupType", cat AS "Category", var AS "Variable", COUNT(*) AS n_rows,
       {", ".join(f'ROUND(SUM(v{i}), 4) AS "{n}"' for i, n in enumerate(NAMES))}
FROM counts GROUP BY 1, 2, 3
""",
)
def admissions_unsuppressed(spark, folder):
    tables = activity_tables(spark, folder)
    counts = admissions_counts(tables, window(tables), splits(spark))
    return counts.groupBy("GroupType", "Category", "Variable").agg(
        F.count("*").alias("n_rows"), *[F.round(F.sum(n), 4).alias(n) for n in NAMES]
    )


GROUP_FLAGS = {
    "Emergency Admissions - Condition Diagnosis": "dem",
    "Emergency Admissions - 65+": "age65",
    "Emergency Admissions - Delirium Diagnosis": "del",
    "Emergency Admissions - MCI Diagnosis": "mci",
    "Emergency Admissions": "1",
}
BUCKETS = {
    "Readmissions30days": "gap <= 30",
    "Readmissions60days": "gap BETWEEN 31 AND 60",
    "Readmissions90days": "gap BETWEEN 61 AND 90",
}


def _readmissions_sql() -> str:
    selects = []
    for group, flag in GROUP_FLAGS.items():
        zero = ", ".join(
            f"CAST(SUM(CASE WHEN {hit} THEN {flag} ELSE 0 END) AS DOUBLE) AS {name}"
            for name, hit in BUCKETS.items()
        )
        null = zero.replace(" ELSE 0", "")
        selects.append(
            f"SELECT m, 'Provider' AS t, prov_name AS o, prov_region AS r, '{group}' AS g, {zero} "
            "FROM pairs GROUP BY m, prov, o, r"
        )
        selects.append(
            f"SELECT m, 'National', 'England', 'All Regions', '{group}', {zero} FROM pairs GROUP BY m"
        )
        weighted = ", ".join(f"SUM({name} * COALESCE(w, 1)) AS {name}" for name in BUCKETS)
        region = "CASE WHEN w IS NULL THEN 'Other' ELSE COALESCE(region_name, 'Other') END"
        for t, code, name in (("Sub-ICB", "sub_code", "sub_name"), ("ICB", "stp_code", "stp_name")):
            selects.append(
                f"SELECT m, '{t}' AS t, COALESCE({name}, 'Other') AS o, {region} AS r, '{group}' AS g, "
                f"{weighted} FROM (SELECT m, sub, {null} FROM pairs GROUP BY m, sub) x "
                f"LEFT JOIN alloc ON sub = old_code GROUP BY m, o, r, COALESCE({code}, 'Other')"
            )
    return " UNION ALL ".join(selects)


@query(
    "admissions_refreshed",
    f"""
WITH {ACTIVITY_SQL}, counts AS ({_admissions_sql()}),
latest AS (SELECT date_trunc('month', GREATEST(MAX(adm), MAX(dis))) AS top FROM stays)
SELECT m AS "Month", t AS "GroupType", r AS "RegionCode", g AS "GeographyName", cat AS "Category",
       var AS "Variable", chap AS "Primary Diagnosis Chapter",
       {", ".join(
           f'''CASE WHEN v{i} < 7 THEN '*' ELSE CAST(CAST(ROUND(v{i}) AS BIGINT) AS VARCHAR) END AS "{n}"'''
           for i, n in enumerate(NAMES))},
       TIMESTAMP '2024-06-01 09:00:00' AS "SnapshotDate"
FROM counts, latest WHERE m BETWEEN top - INTERVAL 11 MONTH AND top
""",
)
def admissions_refreshed(spark, folder):
    """What a refresh inserts when all months but the newest are published."""
    tables = activity_tables(spark, folder)
    newest = window(tables).last
    months = refresh_window(shift_months(newest.replace(day=1), -1)).insert
    return admissions(tables, months, RUN, splits(spark))


READMISSIONS_SQL = f"""
WITH {ACTIVITY_SQL},
months AS (
  SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS m
  FROM (SELECT date_trunc('month', MIN(adm)) AS a, date_trunc('month', MAX(adm)) AS b FROM stays)),
d AS (SELECT m, s.*, ROW_NUMBER() OVER (PARTITION BY m, person
             ORDER BY dis, adm, n_diag DESC, ident) AS rn
      FROM months JOIN stays s ON dis BETWEEN m - 90 AND m - 1 AND cls = '1'),
a AS (SELECT m, s.*, ROW_NUMBER() OVER (PARTITION BY m, person ORDER BY adm, ident) AS rn
      FROM months JOIN stays s ON adm BETWEEN m AND last_day(m) AND cls = '1'),
pairs AS (
  SELECT m, d.dem, d.age65, d.del, d.mci, a.sub, a.prov, a.prov_name, a.prov_region,
         date_diff('day', d.dis, a.adm) AS gap
  FROM d JOIN a USING (m, person) WHERE d.rn = 1 AND a.rn = 1),
counts AS ({_readmissions_sql()})
"""


@query(
    "readmissions_dashboard",
    f"""
{READMISSIONS_SQL}
SELECT m AS "Month", t AS "Org_Type", o AS "Organisation_Name", r AS "Region Name",
       {", ".join(f'ROUND({n}) AS "{n}"' for n in BUCKETS)}, g AS "AdmissionGroup"
FROM counts
""",
)
def readmissions_dashboard(spark, folder):
    tables = activity_tables(spark, folder)
    return readmission_counts(tables, *_months(tables), splits=splits(spark))


def _months(tables):
    """First month with an admission, and how many months there are."""
    low, high = month_bounds(tables["spell"], "Admission_Date")
    return low, (high.year - low.year) * 12 + high.month - low.month + 1


@query(
    "readmissions_published",
    f"""
{READMISSIONS_SQL}
SELECT m AS "Month", t AS "Org_Type", o AS "Organisation_Name", r AS "Region Name",
       {", ".join(
           f'''CASE WHEN ROUND({n}) < 7 THEN '*' ELSE CAST(CAST(ROUND({n}) AS BIGINT) AS VARCHAR) END AS "{n}"'''
           for n in BUCKETS)},
       g AS "AdmissionGroup", TIMESTAMP '2024-06-01 09:00:00' AS "SnapshotDate"
FROM counts
""",
)
def readmissions_published(spark, folder):
    """The suppressed and stamped table."""
    tables = activity_tables(spark, folder)
    first, count = _months(tables)
    return readmissions(tables, first, RUN, count, splits=splits(spark))


@query(
    "admissions_text",
    f"""
WITH {ACTIVITY_SQL}, counts AS ({_admissions_sql()})
SELECT m AS "Month", t AS "GroupType", r AS "RegionCode", g AS "GeographyName", cat AS "Category",
       var AS "Variable", chap AS "Primary Diagnosis Chapter",
       {", ".join(
           f'''CASE WHEN ROUND(v{i}, 6) < 7 THEN '*' ELSE regexp_replace(
                CAST(CAST(ROUND(v{i}, 6) AS DECIMAL(38, 12)) AS VARCHAR), '[.]?0+$', '') END AS "{n}"'''
           for i, n in enumerate(NAMES))}
FROM counts
""",
)
def admissions_text(spark, folder):
    """Shared-out counts as text with all their decimals (to six places)."""
    tables = activity_tables(spark, folder)
    counts = admissions_counts(tables, window(tables), splits(spark))
    rounded = counts.drop("GeographyCode").withColumns({n: F.round(n, 6) for n in NAMES})
    return suppress(rounded, NAMES, digits=None)
