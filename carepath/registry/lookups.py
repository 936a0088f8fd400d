"""Reference data: codes, dictionaries, hierarchies and keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.labels import recode, recode_or_keep
from ..operators.refdata import attach, current, decode, era_key, resolve_code
from ..sources.tables import literal_rows
from .base import query, table

# Reference rows for the demonstration tables.
NATION_RECODES = {
    "NATION_1": "NATION_21",
    "NATION_4": "NATION_22",
    "NATION_7": "NATION_23",
    "NATION_10": "NATION_21",
    "NATION_13": "MERGED_A",
    "NATION_16": "MERGED_B",
}
REGION_NAMES = {"AFRICA": "Africa", "AMERICA": "America", "ASIA": "Asia", "EUROPE": "Europe"}

SEGMENTS = [
    ("BUILDING", "Building trade (old)", date(2015, 1, 1), 0),
    ("BUILDING", "Building trade", None, 1),
    ("MACHINERY", "Machinery", None, 1),
    ("FURNITURE", "Furniture (old)", date(2012, 6, 30), 0),
    ("FURNITURE", "Furniture", None, 1),
    ("HOUSEHOLD", "Household (withdrawn)", date(2014, 12, 31), 0),
]
SEGMENT_SCHEMA = "code string, description string, effective_to date, is_latest int"
SEGMENTS_SQL = """
segments(code, description, effective_to, is_latest) AS (VALUES
  ('BUILDING', 'Building trade (old)', DATE '2015-01-01', 0),
  ('BUILDING', 'Building trade', NULL, 1),
  ('MACHINERY', 'Machinery', NULL, 1),
  ('FURNITURE', 'Furniture (old)', DATE '2012-06-30', 0),
  ('FURNITURE', 'Furniture', NULL, 1),
  ('HOUSEHOLD', 'Household (withdrawn)', DATE '2014-12-31', 0))
"""

CHANGES = [(0, 5), (1, 6), (2, 2), (6, 7), (24, 99)]
CHANGES_SQL = "changes(old_key, new_key) AS (VALUES (0, 5), (1, 6), (2, 2), (6, 7), (24, 99))"


def segments(spark):
    return literal_rows(spark, SEGMENTS, SEGMENT_SCHEMA)


@query(
    "recode_map",
    """
SELECT CASE n_name WHEN 'NATION_1' THEN 'NATION_21' WHEN 'NATION_4' THEN 'NATION_22'
                   WHEN 'NATION_7' THEN 'NATION_23' WHEN 'NATION_10' THEN 'NATION_21'
                   WHEN 'NATION_13' THEN 'MERGED_A' WHEN 'NATION_16' THEN 'MERGED_B'
                   ELSE n_name END AS nation_now,
       CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America'
                   WHEN 'ASIA' THEN 'Asia' WHEN 'EUROPE' THEN 'Europe' END AS region_short,
       COUNT(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
""",
)
def recode_map(spark, folder):
    per_nation = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("k"))
    return (
        per_nation.join(
            table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(
            recode_or_keep("n_name", NATION_RECODES).alias("nation_now"),
            recode("r_name", REGION_NAMES).alias("region_short"),
        )
        .agg(F.sum("k").alias("customers"))
    )


@query(
    "successor_resolve",
    f"""
WITH {CHANGES_SQL}
SELECT COALESCE(n_name, 'Other') AS nation_now, COUNT(*) AS customers
FROM customer LEFT JOIN changes ON c_nationkey = old_key
     LEFT JOIN nation ON COALESCE(new_key, c_nationkey) = n_nationkey
GROUP BY 1
""",
)
def successor_resolve(spark, folder):
    changes = literal_rows(spark, CHANGES, "old_key int, new_key int")
    # Codes are resolved on one row per code.
    per_code = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("k"))
    now = resolve_code(per_code, "c_nationkey", changes, "old_key", "new_key")
    named = attach(
        now, "c_nationkey", table(spark, folder, "nation"), "n_nationkey",
        {"nation_now": "n_name"}, default="Other",
    )
    return named.groupBy("nation_now").agg(F.sum("k").alias("customers"))


@query(
    "scd_current",
    f"""
WITH {SEGMENTS_SQL}
SELECT c_mktsegment, s.description AS open_dated, l.description AS flagged_latest,
       COUNT(*) AS customers
FROM customer
LEFT JOIN segments s ON c_mktsegment = s.code AND s.effective_to IS NULL
LEFT JOIN segments l ON c_mktsegment = l.code AND l.is_latest = 1
GROUP BY ALL
""",
)
def scd_current(spark, folder):
    per_code = table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count("*").alias("customers")
    )
    open_dated = current(segments(spark), end="effective_to")
    latest = current(segments(spark), end=None, flag=("is_latest", 1))
    out = attach(per_code, "c_mktsegment", open_dated, "code", {"open_dated": "description"})
    return attach(out, "c_mktsegment", latest, "code", {"flagged_latest": "description"})


@query(
    "dictionary_decode",
    f"""
WITH {SEGMENTS_SQL}
SELECT COALESCE(description, 'Missing/invalid') AS segment, o_orderpriority, COUNT(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN segments ON c_mktsegment = code AND effective_to IS NULL
GROUP BY ALL
""",
)
def dictionary_decode(spark, folder):
    per_customer = table(spark, folder, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.count("*").alias("k")
    )
    customers = table(spark, folder, "customer", "c_custkey", "c_mktsegment")
    coded = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(F.sum("k").alias("n"))
    )
    named = decode(
        coded, "c_mktsegment", current(segments(spark), end="effective_to"), "segment",
        key="code", value="description",
    )
    return named.groupBy("segment", "o_orderpriority").agg(F.sum("n").alias("n"))


@query(
    "hierarchy_join",
    """
SELECT CASE WHEN h.n_nationkey IS NULL THEN 'Other' ELSE h.n_name END AS org_name,
       CASE WHEN h.n_nationkey IS NULL THEN 'Other' ELSE h.r_name END AS region_name,
       COALESCE(h.r_name, 'Other') AS region_or_other, COUNT(*) AS suppliers,
       ROUND(SUM(s_acctbal), 2) AS balance
FROM supplier LEFT JOIN
  (SELECT n_nationkey, n_name, NULLIF(r_name, 'ASIA') AS r_name
   FROM nation JOIN region ON n_regionkey = r_regionkey) h
  ON s_nationkey = h.n_nationkey AND h.n_name NOT LIKE '%_1%' AND COALESCE(h.r_name, '') <> 'EUROPE'
GROUP BY ALL
""",
)
def hierarchy_join(spark, folder):
    hierarchy = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("r_name", F.nullif("r_name", F.lit("ASIA")))
        # "_" is any character in a SQL pattern.
        .where(~F.col("n_name").like("%_1%") & (F.coalesce("r_name", F.lit("")) != "EUROPE"))
    )
    per_code = table(spark, folder, "supplier").groupBy("s_nationkey").agg(
        F.count("*").alias("k"), F.sum("s_acctbal").alias("b")
    )
    out = attach(
        per_code, "s_nationkey", hierarchy, "n_nationkey",
        {"org_name": "n_name", "region_name": "r_name"}, default="Other", default_when="unmatched",
    )
    return (
        out.withColumn("region_or_other", F.coalesce("region_name", F.lit("Other")))
        .groupBy("org_name", "region_name", "region_or_other")
        .agg(F.sum("k").alias("suppliers"), F.round(F.sum("b"), 2).alias("balance"))
    )


@query(
    "key_normalise",
    f"""
WITH {SEGMENTS_SQL}
SELECT description, COUNT(*) AS customers
FROM (SELECT LOWER(c_mktsegment) || '   ' AS padded FROM customer)
LEFT JOIN segments ON UPPER(RTRIM(padded)) = UPPER(RTRIM(code)) AND effective_to IS NULL
GROUP BY 1
""",
)
def key_normalise(spark, folder):
    padded = table(spark, folder, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.lit("   ")).alias("padded")
    )
    per_code = padded.groupBy("padded").agg(F.count("*").alias("k"))
    found = attach(
        per_code, "padded", current(segments(spark), end="effective_to"), "code",
        {"description": "description"}, collated=True,
    )
    return found.groupBy("description").agg(F.sum("k").alias("customers"))


@query(
    "era_join_key",
    """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'before' ELSE 'after' END AS era,
       c_mktsegment, COUNT(*) AS n
FROM orders LEFT JOIN customer
  ON c_custkey = CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_custkey + 1
                      ELSE o_custkey END
GROUP BY ALL
""",
)
def era_join_key(spark, folder):
    cut = date(1998, 1, 1)
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate").withColumn(
        "derived_key", F.col("o_custkey") + 1
    )
    keyed = (
        orders.select(
            F.when(F.col("o_orderdate") < F.lit(cut), "before").otherwise("after").alias("era"),
            era_key("o_orderdate", cut, "derived_key", "o_custkey").alias("key"),
        )
        .groupBy("era", "key")
        .agg(F.count("*").alias("k"))
    )
    out = attach(
        keyed, "key", table(spark, folder, "customer"), "c_custkey", {"c_mktsegment": "c_mktsegment"}
    )
    return out.groupBy("era", "c_mktsegment").agg(F.sum("k").alias("n"))


@query(
    "org_lookup",
    """
SELECT DISTINCT s_suppkey, COALESCE(m.new_name, n_name) AS nation_now, r_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN (VALUES ('NATION_1', 'NATION_21'), ('NATION_4', 'NATION_22'), ('NATION_7', 'NATION_23'),
                  ('NATION_10', 'NATION_21'), ('NATION_13', 'MERGED_A'), ('NATION_16', 'MERGED_B'))
          m(old_name, new_name) ON n_name = m.old_name
LEFT JOIN region ON n_regionkey = r_regionkey
WHERE n_name LIKE 'NATION_1%'
""",
)
def org_lookup(spark, folder):
    nations = (
        table(spark, folder, "nation")
        .where(F.col("n_name").startswith("NATION_1"))
        .withColumn("nation_now", recode_or_keep("n_name", NATION_RECODES))
    )
    suppliers = table(spark, folder, "supplier", "s_suppkey", "s_nationkey")
    joined = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return attach(
        joined, "n_regionkey", table(spark, folder, "region"), "r_regionkey", {"r_name": "r_name"}
    ).select("s_suppkey", "nation_now", "r_name").distinct()
