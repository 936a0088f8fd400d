"""Population denominators and rates: customers stand for people."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import Band, band_label
from ..operators.population import population, rate
from ..operators.rollup import Category, Geography, labelled_grouping_sets
from .base import query, table

BANDS = [Band(None, 0, "Owing"), Band(0, 5000, "Small"), Band(5000, None, "Large")]
LEVELS = [
    Geography("Nation", "n_name", {"Org_Name": "n_name"}),
    Geography("Region", "r_name", {"Org_Name": "r_name"}),
    Geography("National", None, {}, {"Org_Name": "All"}),
]

PEOPLE_SQL = """
people AS (
  SELECT c_custkey, n_name, r_name,
         CASE WHEN c_acctbal <= 0 THEN 'Owing' WHEN c_acctbal BETWEEN 0 AND 5000 THEN 'Small'
              WHEN c_acctbal >= 5000 THEN 'Large' END AS band
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
pops AS (
  SELECT 'Nation' AS "Org_Type", n_name AS "Org_Name", 'Balance' AS "Category", band AS "Variable",
         CAST(COUNT(*) AS DOUBLE) AS "Pop" FROM people GROUP BY 1, 2, 3, 4
  UNION
  SELECT 'Region', r_name, 'Balance', band, CAST(COUNT(*) AS DOUBLE) FROM people GROUP BY 1, 2, 3, 4
  UNION
  SELECT 'National', 'All', 'Balance', band, CAST(COUNT(*) AS DOUBLE) FROM people GROUP BY 1, 2, 3, 4)
"""


def people(spark, folder):
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name", band_label("c_acctbal", BANDS).alias("band"))
    )


@query("population_bands", f"WITH {PEOPLE_SQL} SELECT * FROM pops")
def population_bands(spark, folder):
    counted = people(spark, folder).withColumn("Count", F.lit(1))
    return population(counted, F.col("band"), "Balance", LEVELS)


@query(
    "rate_per_100k",
    f"""
WITH {PEOPLE_SQL},
open_orders AS (SELECT p.* FROM orders JOIN people p ON o_custkey = c_custkey WHERE o_orderstatus = 'O'),
counts AS (
  SELECT 'Nation' AS "Org_Type", n_name AS "Org_Name", band AS "Variable", COUNT(*) AS n
  FROM open_orders GROUP BY 1, 2, 3
  UNION ALL SELECT 'Region', r_name, band, COUNT(*) FROM open_orders GROUP BY 1, 2, 3
  UNION ALL SELECT 'National', 'All', band, COUNT(*) FROM open_orders GROUP BY 1, 2, 3)
SELECT "Org_Type", "Org_Name", 'Balance' AS "Category", "Variable", n, "Pop",
       n * CAST(100000 AS DOUBLE) / "Pop" AS "Rate"
FROM counts LEFT JOIN (SELECT * REPLACE (CAST("Pop" AS DOUBLE) AS "Pop") FROM pops) USING ("Org_Type", "Org_Name", "Variable")
""",
)
def rate_per_100k(spark, folder):
    orders = (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") == "O")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("k"))
    )
    who = people(spark, folder)
    counts = labelled_grouping_sets(
        orders.join(who, F.col("o_custkey") == F.col("c_custkey")),
        [],
        LEVELS,
        [Category("Balance", "band")],
        {"n": F.sum("k")},
        "Org_Type",
    )
    pops = population_bands(spark, folder)
    return rate(counts, pops, ["Org_Type", "Org_Name", "Category", "Variable"], "n")
