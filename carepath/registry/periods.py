"""Months, windows and the refresh of published tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions.dates import (
    as_date,
    end_of_month,
    latest_month,
    month_bounds,
    month_end,
    month_start,
    refresh_window,
    shift_months,
    Window,
)
from ..operators.refdata import attach
from ..operators.refresh import leaving, monthly_counts, period_filter, replace_latest, roll
from ..sources.publish import stamp
from ..sources.tables import month_spine
from .base import NATION_MONTH_SQL, orders_per_nation_month, query, table


@query(
    "month_spine",
    """
SELECT CAST(m AS DATE) AS "Month", COUNT(o_orderkey) AS n
FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM (
  SELECT date_trunc('month', MIN(o_orderdate)) AS a, date_trunc('month', MAX(o_orderdate)) AS b FROM orders)) g
LEFT JOIN orders ON date_trunc('month', o_orderdate) = m
GROUP BY 1
""",
)
def month_spine_query(spark, folder):
    orders = table(spark, folder, "orders", "o_orderdate")
    low, high = month_bounds(orders, "o_orderdate")
    spine = month_spine(spark, low, (high.year - low.year) * 12 + high.month - low.month + 1)
    return monthly_counts(orders, spine, "o_orderdate")


@query(
    "month_floor",
    """
SELECT src, CAST(date_trunc('month', d) AS DATE) AS month_first, last_day(CAST(d AS DATE)) AS month_last,
       COUNT(*) AS n, MIN(CAST(d AS DATE)) AS first_day
FROM (SELECT 'events' AS src, ts AS d FROM events UNION ALL SELECT 'orders', o_orderdate FROM orders)
GROUP BY 1, 2, 3
""",
)
def month_floor(spark, folder):
    events = table(spark, folder, "events").select(F.lit("events").alias("src"), F.col("ts").alias("d"))
    orders = table(spark, folder, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderdate").alias("d")
    )
    return (
        events.unionByName(orders)
        .groupBy("src", month_start("d").alias("month_first"), month_end("d").alias("month_last"))
        .agg(F.count("*").alias("n"), F.min(as_date("d")).alias("first_day"))
    )


@query(
    "period_bounds",
    """
WITH latest AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM orders)
SELECT CAST(date_trunc('month', d) AS DATE) AS latest_month,
       CAST(last_day(CAST(last_day(d) - INTERVAL 11 MONTH AS DATE)) + 1 AS DATE) AS delete_first,
       last_day(d) AS delete_last,
       CAST(last_day(CAST(last_day(CAST(d + INTERVAL 1 MONTH AS DATE)) - INTERVAL 12 MONTH AS DATE))
            + 1 AS DATE) AS insert_first,
       last_day(CAST(d + INTERVAL 1 MONTH AS DATE)) AS insert_last
FROM latest
""",
)
def period_bounds(spark, folder):
    latest = table(spark, folder, "orders").agg(F.max(as_date("o_orderdate")).alias("d"))
    day, nxt = F.col("d"), F.add_months("d", 1)
    return latest.select(
        month_start(day).alias("latest_month"),
        F.date_add(month_end(F.add_months(month_end(day), -11)), 1).alias("delete_first"),
        month_end(day).alias("delete_last"),
        F.date_add(month_end(F.add_months(month_end(nxt), -12)), 1).alias("insert_first"),
        month_end(nxt).alias("insert_last"),
    )


@query(
    "period_filter",
    """
SELECT c_mktsegment, o_orderstatus, COUNT(*) AS n,
       MIN(CAST(o_orderdate AS DATE)) AS first_day, MAX(CAST(o_orderdate AS DATE)) AS last_day
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
WHERE c_custkey IS NOT NULL AND c_mktsegment <> 'BUILDING'
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-29' AND DATE '1999-12-31'
  AND o_totalprice >= 1000
GROUP BY 1, 2
""",
)
def period_filter_query(spark, folder):
    orders = table(spark, folder, "orders").where(F.col("o_totalprice") >= 1000)
    inside = period_filter(orders, "o_orderdate", Window(date(1996, 2, 29), date(1999, 12, 31)))
    per_customer = inside.groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("k"),
        F.min(as_date("o_orderdate")).alias("a"),
        F.max(as_date("o_orderdate")).alias("b"),
    )
    customers = table(spark, folder, "customer").where(F.col("c_acctbal") > 0)
    # A left join whose right side must be present is an inner join.
    found = attach(
        per_customer, "o_custkey", customers, "c_custkey", {"c_mktsegment": "c_mktsegment"}, how="inner"
    ).where(F.col("c_mktsegment") != "BUILDING")
    return found.groupBy("c_mktsegment", "o_orderstatus").agg(
        F.sum("k").alias("n"), F.min("a").alias("first_day"), F.max("b").alias("last_day")
    )


# The published table holds all but the newest month, as counted before the orders
# in progress were known; the facts now give every month with them.
PUBLISHED_SQL = f"""
{NATION_MONTH_SQL},
newest AS (SELECT MAX("Month") AS m FROM nation_month),
published AS (
  SELECT n_name, "Month", n - n_p AS n, 'old' AS version FROM nation_month, newest WHERE "Month" < m),
fresh AS (SELECT n_name, "Month", n, 'new' AS version FROM nation_month)
"""


def published(spark, folder):
    latest = latest_month(table(spark, folder, "orders", "o_orderdate"), "o_orderdate")
    counts = orders_per_nation_month(spark, folder)
    old = counts.where(F.col("Month") < F.lit(latest)).select(
        "n_name", "Month", (F.col("n") - F.col("n_p")).alias("n"), F.lit("old").alias("version")
    )
    new = counts.select("n_name", "Month", "n", F.lit("new").alias("version"))
    return old, new, latest


@query(
    "refresh_archive",
    f"""
WITH {PUBLISHED_SQL}
SELECT p.* FROM published p, newest
WHERE "Month" BETWEEN m - INTERVAL 11 MONTH AND last_day(CAST(m - INTERVAL 1 MONTH AS DATE))
""",
)
def refresh_archive(spark, folder):
    old, _, latest = published(spark, folder)
    return leaving(old, refresh_window(shift_months(latest, -1)))


@query(
    "refresh_rolling",
    f"""
WITH {PUBLISHED_SQL}
SELECT p.* FROM published p, newest WHERE NOT "Month" BETWEEN m - INTERVAL 11 MONTH AND m
UNION ALL
SELECT f.* FROM fresh f, newest WHERE "Month" BETWEEN m - INTERVAL 11 MONTH AND last_day(m)
""",
)
def refresh_rolling(spark, folder):
    old, new, latest = published(spark, folder)
    return roll(old, new, refresh_window(shift_months(latest, -1)))[0]


@query(
    "refresh_replace_latest",
    f"""
WITH {PUBLISHED_SQL}
SELECT * FROM published WHERE "Month" <> (SELECT MAX("Month") FROM published)
UNION ALL
SELECT f.* FROM fresh f, newest WHERE "Month" BETWEEN m - INTERVAL 1 MONTH AND m
""",
)
def refresh_replace_latest(spark, folder):
    old, new, latest = published(spark, folder)
    return replace_latest(old, new, Window(shift_months(latest, -1), end_of_month(latest)))


@query(
    "snapshot_stamp",
    """
SELECT o_orderstatus, COUNT(*) AS n, 'R' AS "DataSubmissionType",
       TIMESTAMP '2024-02-01 06:30:00' AS "SnapshotDate"
FROM orders GROUP BY 1
""",
)
def snapshot_stamp(spark, folder):
    counts = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return stamp(
        counts.withColumn("DataSubmissionType", F.lit("R")), datetime(2024, 2, 1, 6, 30)
    )
