"""Code lists, text groups and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codes import contains_any, flag_codes, in_codes
from ..functions.labels import code_title, group_codes, group_text
from ..operators.events import primary_secondary
from .base import query, table

METALS = ["ring", "bolt", "gear"]
HEAT = ["hot", "cold"]


@query(
    "codeset_flags",
    """
SELECT l_returnflag, p_type, COUNT(*) AS lines,
       CAST(SUM(CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' OR p_name LIKE '%gear%'
                     THEN 1 ELSE 0 END) AS BIGINT) AS metal,
       CAST(SUM(CASE WHEN p_name LIKE '%hot%' OR p_name LIKE '%cold%' THEN 1 ELSE 0 END) AS BIGINT)
         AS heat,
       CAST(SUM(CASE WHEN p_name LIKE '%red%' THEN 1 ELSE 0 END) AS BIGINT) AS red,
       CAST(SUM(CASE WHEN (p_name LIKE '%ring%' OR p_name LIKE '%bolt%' OR p_name LIKE '%gear%')
                      AND NOT p_name LIKE '%red%' THEN 1 ELSE 0 END) AS BIGINT) AS metal_not_red
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""",
)
def codeset_flags(spark, folder):
    # The text is searched once per part, not once per line.
    parts = table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        flag_codes("p_name", METALS).alias("metal"),
        flag_codes("p_name", HEAT).alias("heat"),
        flag_codes("p_name", ["red"]).alias("red"),
        F.when(contains_any("p_name", METALS) & ~contains_any("p_name", ["red"]), 1)
        .otherwise(0)
        .alias("metal_not_red"),
    )
    lines = table(spark, folder, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.count("*").alias("k")
    )
    flags = ["metal", "heat", "red", "metal_not_red"]
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_returnflag", "p_type")
        .agg(
            F.sum("k").alias("lines"), *[F.sum(F.col(f) * F.col("k")).alias(f) for f in flags]
        )
    )


@query(
    "cohort_codes",
    """
SELECT DISTINCT p_brand AS code, p_type,
       CASE WHEN p_brand IN ('Brand#3', 'Brand#7') THEN 'Minor' ELSE 'Major' END AS area
FROM part
WHERE p_brand IN ('Brand#3', 'Brand#7', 'Brand#11', 'Brand#25', 'Brand#4%') OR p_brand LIKE 'Brand#2%'
""",
)
def cohort_codes(spark, folder):
    listed = ["Brand#3", "Brand#7", "Brand#11", "Brand#25", "Brand#4%"]
    return (
        table(spark, folder, "part", "p_brand", "p_type")
        .where(in_codes("p_brand", listed, ["Brand#2"]))
        .select(
            F.col("p_brand").alias("code"),
            "p_type",
            F.when(F.col("p_brand").isin("Brand#3", "Brand#7"), "Minor")
            .otherwise("Major")
            .alias("area"),
        )
        .distinct()
    )


@query(
    "code_grouping",
    """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fast'
            WHEN o_orderpriority IN ('3-MEDIUM') THEN 'Normal' ELSE 'Not Stated/Not Known' END AS grp,
       o_orderstatus, COUNT(*) AS n
FROM orders GROUP BY 1, 2
""",
)
def code_grouping(spark, folder):
    grp = group_codes(
        "o_orderpriority",
        {"Fast": ["1-URGENT", "2-HIGH"], "Normal": ["3-MEDIUM"]},
        "Not Stated/Not Known",
    )
    return (
        table(spark, folder, "orders", "o_orderpriority", "o_orderstatus")
        .groupBy(grp.alias("grp"), "o_orderstatus")
        .agg(F.count("*").alias("n"))
    )


@query(
    "text_grouping",
    """
SELECT CASE WHEN LOWER(p_name) LIKE '%red%' THEN 'Red' WHEN LOWER(p_name) LIKE '%ring%' THEN 'Ring'
            WHEN LOWER(p_name) LIKE '%e%' THEN 'With E' ELSE 'None' END AS grp,
       COUNT(*) AS parts, MIN(p_name) AS example
FROM part GROUP BY 1
""",
)
def text_grouping(spark, folder):
    grp = group_text("p_name", [("RED", "Red"), ("ring", "Ring"), ("e", "With E")], "None")
    return (
        table(spark, folder, "part", "p_name")
        .groupBy(grp.alias("grp"))
        .agg(F.count("*").alias("parts"), F.min("p_name").alias("example"))
    )


@query(
    "code_title_label",
    """
SELECT p_partkey,
       CASE WHEN brand IS NOT NULL AND title IS NOT NULL THEN concat(brand, ': ', title) END AS label
FROM (SELECT p_partkey, NULLIF(p_brand, 'Brand#3') AS brand, NULLIF(p_type, 'SMALL') AS title FROM part)
""",
)
def code_title_label(spark, folder):
    brand, title = F.nullif("p_brand", F.lit("Brand#3")), F.nullif("p_type", F.lit("SMALL"))
    return table(spark, folder, "part").select("p_partkey", code_title(brand, title).alias("label"))


PRIMARY_SECONDARY_SQL = """
WITH p AS (SELECT DISTINCT l_orderkey, l_shipdate, l_linenumber FROM lineitem WHERE l_returnflag = 'A'),
     s AS (SELECT DISTINCT l_orderkey, l_shipdate, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
     plain AS (
       SELECT DISTINCT p.l_orderkey, p.l_shipdate, p.l_linenumber, 'Primary' AS "Position"
       FROM p LEFT JOIN s USING (l_orderkey, l_shipdate)),
     both_sides AS (
       SELECT DISTINCT COALESCE(p.l_orderkey, s.l_orderkey) AS l_orderkey,
              COALESCE(p.l_shipdate, s.l_shipdate) AS l_shipdate,
              COALESCE(p.l_linenumber, s.l_linenumber) AS l_linenumber,
              CASE WHEN p.l_linenumber IS NOT NULL THEN 'Primary' ELSE 'Secondary' END AS "Position"
       FROM p FULL OUTER JOIN s ON p.l_orderkey = s.l_orderkey AND p.l_shipdate = s.l_shipdate)
SELECT 'plain' AS mode, "Position", COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS orders,
       CAST(SUM(l_linenumber) AS BIGINT) AS check_sum FROM plain GROUP BY ALL
UNION ALL
SELECT 'secondary too', "Position", COUNT(*), COUNT(DISTINCT l_orderkey),
       CAST(SUM(l_linenumber) AS BIGINT) FROM both_sides GROUP BY ALL
"""


@query("primary_secondary", PRIMARY_SECONDARY_SQL)
def primary_secondary_query(spark, folder):
    columns = ["l_orderkey", "l_shipdate", "l_linenumber"]
    lines = table(spark, folder, "lineitem", *columns, "l_returnflag")
    primary = lines.where("l_returnflag = 'A'").select(*columns).distinct()
    secondary = lines.where("l_returnflag = 'R'").select(*columns).distinct()
    out = None
    for mode, both in (("plain", False), ("secondary too", True)):
        rows = primary_secondary(primary, secondary, ["l_orderkey", "l_shipdate"], both)
        # One row per order before the totals, in place of a distinct count.
        per_order = rows.groupBy("Position", "l_orderkey").agg(
            F.count("*").alias("k"), F.sum("l_linenumber").alias("s")
        )
        part = per_order.groupBy("Position").agg(
            F.sum("k").alias("n"), F.count("*").alias("orders"), F.sum("s").alias("check_sum")
        ).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out
