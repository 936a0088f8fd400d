"""Control charts, rates, rollups and unions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators.rollup import Geography, org_rollup, ratio_of_sums
from ..operators.spc import p_chart, split_phase
from ..sources.tables import distinct_union, era_union
from .base import NATION_MONTH_SQL, orders_per_nation_month, query, table

ORG = ["n_nationkey", "n_name"]
SPLIT = date(1998, 1, 1)

LIMITS_SQL = """
  p{s} AS pbar{s},
  p{s} + 3 * SQRT(p{s} * (1 - p{s}) / n) AS "UCL{s}",
  p{s} - 3 * SQRT(p{s} * (1 - p{s}) / n) AS "LCL{s}"
"""


@query(
    "pchart_full",
    f"""
WITH {NATION_MONTH_SQL},
bar AS (
  SELECT n_nationkey, CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS p
  FROM nation_month GROUP BY n_nationkey)
SELECT n_name, "Month", n_f, n, CAST(n_f AS DOUBLE) / n AS rate, {LIMITS_SQL.format(s="")}
FROM nation_month JOIN bar USING (n_nationkey)
""",
)
def pchart_full(spark, folder):
    points = orders_per_nation_month(spark, folder)
    chart = p_chart(points, ORG, {"": "n_f"}, "n", code="n_nationkey")
    return chart.withColumn("rate", F.try_divide(F.col("n_f").cast("double"), "n")).select(
        "n_name", "Month", "n_f", "n", "rate", "pbar", "UCL", "LCL"
    )


@query(
    "pchart_phased",
    f"""
WITH {NATION_MONTH_SQL},
phased AS (
  SELECT *, CASE WHEN "Month" < DATE '1998-01-01' THEN 'before'
                 WHEN "Month" > DATE '1998-01-01' THEN 'after' END AS phase
  FROM nation_month),
whole AS (
  SELECT n_nationkey, CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS p2
  FROM phased GROUP BY n_nationkey),
part AS (
  SELECT n_nationkey, phase, CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS p
  FROM phased WHERE phase IS NOT NULL GROUP BY n_nationkey, phase)
SELECT n_name, "Month", n_f, n, {LIMITS_SQL.format(s="")}, {LIMITS_SQL.format(s="2")}
FROM phased JOIN whole USING (n_nationkey) JOIN part USING (n_nationkey, phase)
""",
)
def pchart_phased(spark, folder):
    points = orders_per_nation_month(spark, folder)
    full = p_chart(points, ORG, {"2": "n_f"}, "n", code="n_nationkey")
    return p_chart(full, ORG, {"": "n_f"}, "n", phase=split_phase("Month", SPLIT)).select(
        "n_name", "Month", "n_f", "n", "pbar", "UCL", "LCL", "pbar2", "UCL2", "LCL2"
    )


@query(
    "pchart_multi",
    f"""
WITH {NATION_MONTH_SQL},
bar AS (
  SELECT n_nationkey, CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS p,
         CAST(SUM(n_p) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS p2
  FROM nation_month GROUP BY n_nationkey)
SELECT n_name, "Month", n_f, n_p, n, {LIMITS_SQL.format(s="")}, {LIMITS_SQL.format(s="2")}
FROM nation_month JOIN bar USING (n_nationkey)
""",
)
def pchart_multi(spark, folder):
    points = orders_per_nation_month(spark, folder)
    chart = p_chart(points, ORG, {"": "n_f", "2": "n_p"}, "n", code="n_nationkey")
    return chart.select(
        "n_name", "Month", "n_f", "n_p", "n", "pbar", "UCL", "LCL", "pbar2", "UCL2", "LCL2"
    )


@query(
    "ratio_of_sums",
    """
SELECT l_returnflag, l_linestatus,
       ROUND(SUM(l_extendedprice * (1 - l_discount)) / SUM(l_extendedprice), 6) AS net_share,
       SUM(l_quantity) FILTER (WHERE l_discount > 0.05) / SUM(l_quantity) AS discounted_share
FROM lineitem GROUP BY l_returnflag, l_linestatus
""",
)
def ratio_of_sums_query(spark, folder):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    discounted = F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(ratio_of_sums(net, F.col("l_extendedprice")), 6).alias("net_share"),
            ratio_of_sums(discounted, F.col("l_quantity")).alias("discounted_share"),
        )
    )


@query(
    "org_rollup",
    f"""
WITH {NATION_MONTH_SQL}
SELECT 'Nation' AS org_type, n_name AS org_name, r_name AS parent, "Month",
       CAST(SUM(n_f) AS DOUBLE) AS n_f, CAST(SUM(n) AS DOUBLE) AS n,
       CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS rate
FROM nation_month JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name, "Month"
UNION
SELECT 'Region', r_name, NULL, "Month", CAST(SUM(n_f) AS DOUBLE), CAST(SUM(n) AS DOUBLE),
       CAST(SUM(n_f) AS DOUBLE) / CAST(SUM(n) AS DOUBLE)
FROM nation_month JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, "Month"
UNION
SELECT 'National', 'All', NULL, CAST(date_trunc('month', o_orderdate) AS DATE),
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE), CAST(COUNT(*) AS DOUBLE),
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
FROM orders GROUP BY 4
""",
)
def org_rollup_query(spark, folder):
    facts = orders_per_nation_month(spark, folder).join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    published = (
        table(spark, folder, "orders")
        .groupBy(month_start("o_orderdate").alias("Month"))
        .agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_f"), F.count("*").alias("n"))
    )
    return org_rollup(
        facts,
        ["Month"],
        ["n_f", "n"],
        [
            Geography("Nation", "n_name", {"org_name": "n_name", "parent": "r_name"}),
            Geography("Region", "r_name", {"org_name": "r_name"}, {"parent": None}),
        ],
        ratios={"rate": ("n_f", "n")},
        national=published,
        national_level=Geography("National", None, {}, {"org_name": "All"}),
        level="org_type",
    )


@query(
    "union_distinct",
    """
SELECT 'trade' AS side, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION
SELECT 'trade', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION
SELECT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
)
def union_distinct(spark, folder):
    nation = table(spark, folder, "nation", "n_nationkey", "n_name")
    buyers = table(spark, folder, "customer", "c_nationkey", "c_mktsegment").distinct()
    sellers = table(spark, folder, "supplier", "s_nationkey").distinct()
    buyers = buyers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sellers = sellers.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return distinct_union(
        buyers.select(F.lit("trade").alias("side"), "n_name"),
        sellers.select(F.lit("trade"), "n_name"),
        buyers.select("c_mktsegment", "n_name"),
    )


@query(
    "era_union",
    """
SELECT era, CAST(date_trunc('month', o_orderdate) AS DATE) AS "Month", o_orderstatus,
       COUNT(*) AS n
FROM (SELECT 'old' AS era, o_orderdate, o_orderstatus FROM orders
      WHERE o_orderdate < TIMESTAMP '1998-01-01'
      UNION ALL
      SELECT 'new', o_orderdate, o_orderstatus FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-01-01')
GROUP BY ALL
""",
)
def era_union_query(spark, folder):
    orders = table(spark, folder, "orders", "o_orderdate", "o_orderstatus")
    day = F.col("o_orderdate")
    old = orders.where(day < F.lit(SPLIT)).withColumn("era", F.lit("old"))
    new = orders.where(day >= F.lit(SPLIT)).withColumn("era", F.lit("new"))
    return (
        era_union(old, new, columns=["era", "o_orderdate", "o_orderstatus"])
        .groupBy("era", month_start("o_orderdate").alias("Month"), "o_orderstatus")
        .agg(F.count("*").alias("n"))
    )
