"""Reshaping, grouping sets, weights, display and bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import Band, STAY_BANDS, band_label
from ..functions.dates import month_start
from ..functions.disclosure import round_count, suppress
from ..operators.reshape import pivot_measures, unpivot_groups
from ..operators.rollup import ALL, Category, Geography, labelled_grouping_sets
from ..operators.weights import reallocate
from ..sources.tables import literal_rows
from .base import NATION_MONTH_SQL, orders_per_customer_month, orders_per_nation_month, query, table


@query(
    "pivot_measures",
    """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Month", l_linestatus,
       MAX(l_quantity) FILTER (WHERE l_returnflag = 'A') AS max_a,
       MAX(l_quantity) FILTER (WHERE l_returnflag = 'R') AS max_r
FROM lineitem GROUP BY ALL
""",
)
def pivot_measures_query(spark, folder):
    long = table(spark, folder, "lineitem").select(
        month_start("l_shipdate").alias("Month"), "l_linestatus", "l_returnflag", "l_quantity"
    )
    return pivot_measures(long, "l_returnflag", "l_quantity", {"max_a": "A", "max_r": "R"})


@query(
    "unpivot_groups",
    f"""
WITH {NATION_MONTH_SQL},
wide AS (
  SELECT n_name, "Month", NULLIF(n_f, 0) AS f, NULLIF(n_p, 0) AS p, n FROM nation_month)
SELECT n_name, "Month", f AS first_count, n - f AS other_count, n AS all_count, 'F' AS grp FROM wide
UNION ALL
SELECT n_name, "Month", p, n - p, n, 'P' FROM wide
""",
)
def unpivot_groups_query(spark, folder):
    wide = orders_per_nation_month(spark, folder).select(
        "n_name",
        "Month",
        F.nullif("n_f", F.lit(0)).alias("f"),
        F.nullif("n_p", F.lit(0)).alias("p"),
        "n",
    )
    wide = wide.withColumns({"not_f": F.col("n") - F.col("f"), "not_p": F.col("n") - F.col("p")})
    return unpivot_groups(
        wide,
        ["n_name", "Month"],
        {"F": ["f", "not_f", "n"], "P": ["p", "not_p", "n"]},
        ["first_count", "other_count", "all_count"],
        "grp",
    )


GEOGRAPHIES = [
    Geography("Nation", "n_name", {"GeographyName": "n_name"}),
    Geography("National", None, {}, {"GeographyName": "All"}),
]


@query(
    "grouping_sets_labels",
    """
WITH base AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Month", n_name,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_orderstatus, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT "Month", CASE WHEN GROUPING(n_name) = 0 THEN 'Nation' ELSE 'National' END AS "GroupType",
       CASE WHEN GROUPING(n_name) = 0 THEN n_name ELSE 'All' END AS "GeographyName",
       CASE WHEN GROUPING(priority) = 0 THEN 'Priority' WHEN GROUPING(o_orderstatus) = 0
            THEN 'Status' WHEN GROUPING(c_mktsegment) = 0 THEN 'Segment' ELSE 'Total' END
         AS "Category",
       CASE WHEN GROUPING(priority) = 0 THEN priority WHEN GROUPING(o_orderstatus) = 0
            THEN o_orderstatus WHEN GROUPING(c_mktsegment) = 0 THEN c_mktsegment ELSE 'Total' END
         AS "Variable",
       COUNT(*) AS n, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_f
FROM base GROUP BY GROUPING SETS (
  ("Month"), ("Month", priority), ("Month", o_orderstatus), ("Month", c_mktsegment),
  ("Month", n_name), ("Month", n_name, priority), ("Month", n_name, o_orderstatus),
  ("Month", n_name, c_mktsegment))
""",
)
def grouping_sets_labels(spark, folder):
    # Counted per customer first; the grouping sets then see customer rows, not orders.
    counts = orders_per_customer_month(spark, folder, "o_orderpriority", "o_orderstatus")
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    base = (
        counts.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("priority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    )
    return labelled_grouping_sets(
        base,
        ["Month"],
        GEOGRAPHIES,
        [
            ALL,
            Category("Priority", "priority"),
            Category("Status", "o_orderstatus"),
            Category("Segment", "c_mktsegment"),
        ],
        {"n": F.sum("n"), "n_f": F.sum("n_f")},
        "GroupType",
        additive=True,
    )


@query(
    "grouping_sets_carry",
    """
SELECT 'All' AS "GroupType",
       CASE WHEN GROUPING(p_brand) = 0 THEN 'Brand' WHEN GROUPING(l_returnflag) = 0
            THEN 'Flag' ELSE 'Total' END AS "Category",
       CASE WHEN GROUPING(p_brand) = 0 THEN p_brand WHEN GROUPING(l_returnflag) = 0
            THEN l_returnflag ELSE 'Total' END AS "Variable",
       CASE WHEN GROUPING(p_brand) = 0 THEN p_type END AS p_type,
       COUNT(*) AS n, SUM(l_quantity) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY GROUPING SETS ((), (p_brand, p_type), (l_returnflag))
""",
)
def grouping_sets_carry(spark, folder):
    per_part = table(spark, folder, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.count("*").alias("k"), F.sum("l_quantity").alias("q")
    )
    parts = table(spark, folder, "part", "p_partkey", "p_brand", "p_type")
    return labelled_grouping_sets(
        per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")),
        [],
        [Geography("All", None)],
        [ALL, Category("Brand", "p_brand", ("p_type",)), Category("Flag", "l_returnflag")],
        {"n": F.sum("k"), "quantity": F.sum("q")},
        "GroupType",
    )


@query(
    "two_stage_rollup",
    f"""
WITH {NATION_MONTH_SQL},
low AS (SELECT "Month", n_name, r_name, n * 0.5 AS w
        FROM nation_month JOIN region ON n_regionkey = r_regionkey)
SELECT "Month", CASE WHEN GROUPING(n_name) = 0 THEN 'Nation' ELSE 'Region' END AS "OrgType",
       CASE WHEN GROUPING(n_name) = 0 THEN n_name ELSE r_name END AS "OrgName",
       CAST(SUM(w) AS DOUBLE) AS weighted
FROM low GROUP BY GROUPING SETS (("Month", n_name), ("Month", r_name))
""",
)
def two_stage_rollup(spark, folder):
    low = orders_per_nation_month(spark, folder).join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    half = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("key"), F.lit(0.5).alias("w"), F.col("n_name").alias("to")
    )
    shared = reallocate(low, "n_nationkey", half, ["n"], "key", {"__to": "to"}, weight="w")
    return labelled_grouping_sets(
        shared,
        ["Month"],
        [
            Geography("Nation", "n_name", {"OrgName": "n_name"}),
            Geography("Region", "r_name", {"OrgName": "r_name"}),
        ],
        [ALL],
        {"weighted": F.sum("n")},
        "OrgType",
    ).drop("Category", "Variable")


# One nation split over three, with the three population weights.
SPLIT = [
    (0, 0.18204175443292, "NATION_5"),
    (0, 0.229339252148803, "NATION_9"),
    (0, 0.588618993418278, "NATION_14"),
]


@query(
    "reweight_fanout",
    f"""
WITH {NATION_MONTH_SQL},
split(old_key, weight, new_name) AS (VALUES
  (0, CAST(0.18204175443292 AS DOUBLE), 'NATION_5'),
  (0, CAST(0.229339252148803 AS DOUBLE), 'NATION_9'),
  (0, CAST(0.588618993418278 AS DOUBLE), 'NATION_14'),
  (1, CAST(1 AS DOUBLE), 'NATION_1'), (2, CAST(1 AS DOUBLE), 'NATION_2'))
SELECT COALESCE(new_name, 'Other') AS org_name, "Month",
       ROUND(SUM(n * COALESCE(weight, 1)), 6) AS n,
       ROUND(SUM(n_f * COALESCE(weight, 1)), 6) AS n_f,
       MAX(COALESCE(weight, 1)) AS weight
FROM nation_month LEFT JOIN split ON n_nationkey = old_key GROUP BY 1, 2
""",
)
def reweight_fanout(spark, folder):
    rows = [*SPLIT, (1, 1.0, "NATION_1"), (2, 1.0, "NATION_2")]
    allocation = literal_rows(spark, rows, "old_key int, weight double, new_name string")
    shared = reallocate(
        orders_per_nation_month(spark, folder),
        "n_nationkey",
        allocation,
        ["n", "n_f"],
        "old_key",
        {"org_name": "new_name"},
        weight="weight",
    )
    return shared.groupBy("org_name", "Month").agg(
        F.round(F.sum("n"), 6).alias("n"),
        F.round(F.sum("n_f"), 6).alias("n_f"),
        F.max("weight").alias("weight"),
    )


SHIPPED_SQL = """
shipped AS (
  SELECT n_name, CAST(date_trunc('month', l_shipdate) AS DATE) AS "Month", l_returnflag,
         COUNT(*) AS lines, COUNT(*) FILTER (WHERE l_linestatus = 'O') AS open_lines
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)
"""


def shipped(spark, folder):
    per_supplier = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", month_start("l_shipdate").alias("Month"), "l_returnflag")
        .agg(F.count("*").alias("k"), F.count_if(F.col("l_linestatus") == "O").alias("o"))
    )
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_nationkey")
    nation = table(spark, folder, "nation", "n_nationkey", "n_name")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "Month", "l_returnflag")
        .agg(F.sum("k").alias("lines"), F.sum("o").alias("open_lines"))
    )


@query(
    "suppress_small",
    f"""
WITH {SHIPPED_SQL}
SELECT n_name, "Month", l_returnflag,
       CASE WHEN lines < 7 THEN '*' ELSE CAST(lines AS VARCHAR) END AS lines,
       CASE WHEN half < 7 THEN '*' ELSE CAST(CAST(ROUND(half) AS BIGINT) AS VARCHAR) END AS half,
       CASE WHEN half < 7 THEN '*' ELSE CAST(CAST(half AS DECIMAL(18, 1)) AS VARCHAR) END AS half_1
FROM (SELECT *, NULLIF(open_lines, 0) * CAST(0.5 AS DOUBLE) AS half FROM shipped)
""",
)
def suppress_small(spark, folder):
    half = F.nullif("open_lines", F.lit(0)) * F.lit(0.5)
    counts = shipped(spark, folder).select(
        "n_name", "Month", "l_returnflag", "lines", half.alias("half"), half.alias("half_1")
    )
    return suppress(suppress(counts, ["lines", "half"]), ["half_1"], digits=1)


@query(
    "round_counts",
    f"""
WITH {SHIPPED_SQL}
SELECT n_name, "Month", l_returnflag, ROUND(lines * CAST(0.5 AS DOUBLE)) AS up,
       ROUND(lines * CAST(-0.5 AS DOUBLE)) AS down,
       ROUND(lines * CAST(0.229339252148803 AS DOUBLE)) AS weighted
FROM shipped
""",
)
def round_counts(spark, folder):
    lines = F.col("lines")
    return shipped(spark, folder).select(
        "n_name",
        "Month",
        "l_returnflag",
        round_count(lines * 0.5).alias("up"),
        round_count(lines * -0.5).alias("down"),
        round_count(lines * 0.229339252148803).alias("weighted"),
    )


SIZE_BANDS = [Band(None, 9, "Under10"), Band(10, 24, "10to24"), Band(25, 39, "25to39")]


@query(
    "age_bands",
    """
SELECT CASE WHEN p_size < 10 THEN 'Under10' WHEN p_size BETWEEN 10 AND 24 THEN '10to24'
            WHEN p_size BETWEEN 25 AND 39 THEN '25to39' ELSE 'Unknown/Not Stated' END AS band,
       p_type, COUNT(*) AS parts, CAST(MIN(p_size) AS INTEGER) AS smallest, MAX(p_size) AS largest
FROM (SELECT p_type, NULLIF(p_size, 11) AS p_size FROM part) GROUP BY 1, 2
""",
)
def age_bands(spark, folder):
    parts = table(spark, folder, "part", "p_type", "p_size").withColumn(
        "p_size", F.nullif("p_size", F.lit(11))
    )
    return parts.groupBy(
        band_label("p_size", SIZE_BANDS, "Unknown/Not Stated").alias("band"), "p_type"
    ).agg(
        F.count("*").alias("parts"),
        F.min("p_size").alias("smallest"),
        F.max("p_size").alias("largest"),
    )


@query(
    "los_bands",
    """
SELECT CASE WHEN stay <= 1 THEN '1 Day or less' WHEN stay BETWEEN 2 AND 3 THEN 'Between 2 and 3 Days'
            WHEN stay BETWEEN 4 AND 10 THEN 'Between 4 and 10 Days'
            WHEN stay BETWEEN 11 AND 21 THEN 'Between 11 and 21 Days'
            WHEN stay > 21 THEN 'More than 21 Days' END AS band,
       l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS quantity
FROM (SELECT NULLIF(CAST(l_quantity AS INTEGER), 30) AS stay, l_returnflag, l_quantity FROM lineitem)
GROUP BY 1, 2
""",
)
def los_bands(spark, folder):
    stays = table(spark, folder, "lineitem", "l_quantity", "l_returnflag").withColumn(
        "stay", F.nullif(F.col("l_quantity").cast("int"), F.lit(30))
    )
    return stays.groupBy(band_label("stay", STAY_BANDS).alias("band"), "l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )
