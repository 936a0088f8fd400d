"""Readmissions over every month of the orders.

Orders of a priority that starts with 2 stand for emergency spells of a customer,
admitted on the order date and discharged the next day.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import is_emergency
from ..functions.dates import as_date
from ..operators.readmissions import bucket_columns, readmission_pairs
from ..operators.refdata import attach
from ..operators.rollup import ALL, Geography, labelled_grouping_sets
from .base import query, table

PAIRS_SQL = """
spells AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS admitted,
         CAST(o_orderdate AS DATE) + 1 AS discharged, o_orderstatus,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f
  FROM orders WHERE o_orderpriority LIKE '2%'),
bounds AS (SELECT date_trunc('month', MIN(o_orderdate)) AS a, MAX(o_orderdate) AS b FROM orders),
months AS (
  SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS "Month" FROM bounds),
d AS (
  SELECT "Month", s.*, ROW_NUMBER() OVER (PARTITION BY "Month", o_custkey
                        ORDER BY discharged {direction}, o_orderkey) AS rn
  FROM months JOIN spells s ON discharged BETWEEN "Month" - 90 AND "Month" - 1),
a AS (
  SELECT "Month", s.*, ROW_NUMBER() OVER (PARTITION BY "Month", o_custkey
                        ORDER BY admitted, o_orderkey) AS rn
  FROM months JOIN spells s ON admitted BETWEEN "Month" AND last_day("Month")),
pairs AS (
  SELECT "Month", d.o_custkey, d.o_orderkey AS discharge_order, d.discharged, d.is_f,
         a.o_orderkey AS admission_order, a.admitted,
         CAST(date_diff('day', d.discharged, a.admitted) AS INTEGER) AS "TimeBetweenAdmissions"
  FROM d JOIN a USING ("Month", o_custkey) WHERE d.rn = 1 AND a.rn = 1)
"""


def pairs(spark, folder, pick="earliest"):
    orders = table(spark, folder, "orders")
    # One row of bounds, read from one column.
    low, high = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    first = low.date().replace(day=1)
    count = (high.year - first.year) * 12 + high.month - first.month + 1
    spells = orders.where(is_emergency("o_orderpriority")).select(
        "o_custkey",
        "o_orderkey",
        as_date("o_orderdate").alias("admitted"),
        F.date_add(as_date("o_orderdate"), 1).alias("discharged"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_f"),
    )
    return readmission_pairs(
        spells.drop("admitted").withColumnRenamed("o_orderkey", "discharge_order"),
        spells.drop("discharged", "is_f").withColumnRenamed("o_orderkey", "admission_order"),
        "o_custkey",
        "discharged",
        "admitted",
        first,
        count,
        pick=pick,
        discharge_carry=["discharge_order", "is_f"],
        admission_carry=["admission_order"],
    )


@query("readmissions_monthly", f"WITH {PAIRS_SQL.format(direction='ASC')} SELECT * FROM pairs")
def readmissions_monthly(spark, folder):
    return pairs(spark, folder)


@query("readmissions_latest", f"WITH {PAIRS_SQL.format(direction='DESC')} SELECT * FROM pairs")
def readmissions_latest(spark, folder):
    return pairs(spark, folder, pick="latest")


def _bucket_sql(empty: str) -> str:
    edges = {
        30: '"TimeBetweenAdmissions" <= 30',
        60: '"TimeBetweenAdmissions" BETWEEN 31 AND 60',
        90: '"TimeBetweenAdmissions" BETWEEN 61 AND 90',
    }
    return ", ".join(
        f'CAST(SUM(CASE WHEN {hit} THEN {flag} {empty} END) AS BIGINT) AS "{name} - Readmissions{edge}days"'
        for edge, hit in edges.items()
        for name, flag in (("Total", "1"), ("Done", "is_f"))
    )


@query(
    "readmission_buckets",
    f"""
WITH {PAIRS_SQL.format(direction='ASC')},
named AS (SELECT pairs.*, n_name FROM pairs JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey)
SELECT "Month", 'Nation' AS "Org_Type", n_name AS "OrgName", {_bucket_sql("")}
FROM named GROUP BY 1, 2, 3
UNION ALL
SELECT "Month", 'National', 'All', {_bucket_sql("ELSE 0")} FROM named GROUP BY 1, 2, 3
""",
)
def readmission_buckets(spark, folder):
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    found = attach(
        pairs(spark, folder), "o_custkey", table(spark, folder, "customer"), "c_custkey",
        {"c_nationkey": "c_nationkey"}, how="inner",
    )
    found = attach(found, "c_nationkey", nations, "n_nationkey", {"n_name": "n_name"}, how="inner")
    flags = {"Total": None, "Done": "is_f"}
    nation = Geography("Nation", "n_name", {"OrgName": "n_name"})
    everyone = Geography("National", None, {}, {"OrgName": "All"})
    gap = "TimeBetweenAdmissions"
    low = labelled_grouping_sets(
        found, ["Month"], [nation], [ALL], bucket_columns(gap, flags, empty_as_null=True), "Org_Type"
    )
    top = labelled_grouping_sets(
        found, ["Month"], [everyone], [ALL], bucket_columns(gap, flags), "Org_Type"
    )
    return low.unionByName(top).drop("Category", "Variable")
