"""Events, waits, caseload and the metric matrix.

Orders stand for referrals and lines for what happens to them: a line's ship month
is a monthly submission of the order, its ship date a contact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.bands import Band, band_flags, band_label
from ..functions.caseload import caseload_flags, in_period, wait_days
from ..functions.dates import as_date, local_time, month_end, month_start
from ..functions.labels import group_codes, order_label
from ..operators.events import earliest_latest, first_event
from ..operators.refdata import attach
from ..operators.rollup import ALL, Category, Geography, labelled_grouping_sets
from .base import query, table


@query(
    "earliest_latest",
    """
SELECT f.user_id, f.ts AS "EarliestTs", f.event_type AS "EarliestType", f.event_id AS "EarliestId",
       l.ts AS "LatestTs", l.event_type AS "LatestType", l.event_id AS "LatestId"
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
             ORDER BY CAST(ts AS DATE), event_type DESC, event_id) AS rn FROM events) f
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
             ORDER BY CAST(ts AS DATE) DESC, event_type, event_id DESC) AS rn FROM events) l
  ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1
""",
)
def earliest_latest_query(spark, folder):
    # Ties within a day go to a type, reverse-alphabetic first and alphabetic last: its code
    # points, turned around, are an order of any text.
    turned = F.concat(F.transform(F.split("event_type", ""), lambda c: -F.ascii(c)), F.array(F.lit(1)))
    events = table(spark, folder, "events", "user_id", "ts", "event_type", "event_id").select(
        "user_id", F.col("event_id").alias("Id"), F.col("ts").alias("Ts"),
        F.col("event_type").alias("Type"), as_date("ts").alias("day"), turned.alias("turned"),
    )
    return earliest_latest(
        events,
        ["user_id"],
        ["Id", "Ts", "Type"],
        first=[F.col("day"), F.col("turned")],
        last=[F.col("day"), F.col("turned")],
    )


@query(
    "first_contact",
    """
SELECT l_orderkey, MIN(CAST(l_shipdate AS DATE)) AS first_contact
FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' GROUP BY l_orderkey
""",
)
def first_contact(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("shipped", as_date("l_shipdate"))
    attended = F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F")
    return first_event(lines, ["l_orderkey"], "shipped", attended, "first_contact")


def referrals(spark, folder):
    """Each order with its first qualifying shipment."""
    orders = table(spark, folder, "orders").withColumn("received", as_date("o_orderdate"))
    contacts = first_contact(spark, folder)
    return orders.join(contacts, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


REFERRALS_SQL = """
referrals AS (
  SELECT o.*, CAST(o_orderdate AS DATE) AS received, first_contact
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, MIN(CAST(l_shipdate AS DATE)) AS first_contact FROM lineitem
    WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' GROUP BY l_orderkey) c
  ON o_orderkey = l_orderkey)
"""
AS_OF = date(2000, 12, 31)
WAIT_SQL = """
waits AS (
  SELECT *, CASE WHEN first_contact IS NOT NULL AND first_contact >= received
                  AND first_contact <= DATE '2000-12-31'
                 THEN CAST(date_diff('day', received, first_contact) AS INTEGER) END AS wait
  FROM referrals)
"""


def with_wait(spark, folder):
    return referrals(spark, folder).withColumn(
        "wait", wait_days("received", "first_contact", F.lit(AS_OF))
    )


@query(
    "wait_days",
    f"WITH {REFERRALS_SQL}, {WAIT_SQL} SELECT o_orderkey, received, first_contact, wait FROM waits",
)
def wait_days_query(spark, folder):
    return with_wait(spark, folder).select("o_orderkey", "received", "first_contact", "wait")


@query(
    "wait_bands",
    f"""
WITH {REFERRALS_SQL}, {WAIT_SQL}
SELECT CAST(date_trunc('month', received) AS DATE) AS "Month", o_orderpriority,
       CAST(SUM(CASE WHEN wait <= 42 THEN 1 ELSE 0 END) AS BIGINT) AS "ContactUnder6weeksNumber",
       CAST(SUM(CASE WHEN wait > 42 AND wait <= 126 THEN 1 ELSE 0 END) AS BIGINT)
         AS "Contact6to18weeksNumber",
       CAST(SUM(CASE WHEN wait > 126 THEN 1 ELSE 0 END) AS BIGINT) AS "ContactOver18weeksNumber",
       CAST(SUM(CASE WHEN wait IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS "TotalReferralsWithContact"
FROM waits GROUP BY 1, 2
""",
)
def wait_bands(spark, folder):
    flags = band_flags(
        "wait", "Contact", requires="o_orderkey", total="TotalReferralsWithContact"
    )
    return (
        with_wait(spark, folder)
        .withColumns(flags)
        .groupBy(month_start("received").alias("Month"), "o_orderpriority")
        .agg(*[F.sum(f).alias(f) for f in flags])
    )


@query(
    "event_order_label",
    f"""
WITH {REFERRALS_SQL}
SELECT CASE WHEN first_contact >= received THEN 'Shipped After Order'
            WHEN first_contact < received THEN 'Shipped Before Order' ELSE 'Not Shipped' END AS label,
       o_orderstatus, COUNT(*) AS n
FROM referrals GROUP BY 1, 2
""",
)
def event_order_label(spark, folder):
    label = order_label(
        "first_contact", "received", "Shipped After Order", "Shipped Before Order", "Not Shipped"
    )
    return (
        referrals(spark, folder)
        .groupBy(label.alias("label"), "o_orderstatus")
        .agg(F.count("*").alias("n"))
    )


BASE_SQL = f"""
{REFERRALS_SQL},
submissions AS (
  SELECT DISTINCT l_orderkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start,
         last_day(CAST(l_shipdate AS DATE)) AS period_end
  FROM lineitem),
discharges AS (
  SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS discharged FROM lineitem
  WHERE l_returnflag = 'N' GROUP BY l_orderkey),
latest AS (
  SELECT l_orderkey, l_returnflag AS latest_flag FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
              ORDER BY l_shipdate DESC, l_returnflag DESC) AS rn FROM lineitem) WHERE rn = 1),
base AS (
  SELECT period_start AS "Month", o_orderkey, COALESCE(n_name, 'Other') AS "Sub_ICB_Name",
         COALESCE(r_name, 'Other') AS "ICB_Name", c_mktsegment AS "Provider_Name",
         c_acctbal, o_orderstatus, o_orderpriority, latest_flag,
         CASE WHEN first_contact >= received AND first_contact <= period_end
              THEN CAST(date_diff('day', received, first_contact) AS INTEGER) END AS wait,
         CASE WHEN first_contact BETWEEN period_start AND period_end THEN 1 ELSE 0 END AS "SeenNow",
         CASE WHEN received BETWEEN period_start AND period_end THEN 1 ELSE 0 END AS "NewRef",
         CASE WHEN discharged BETWEEN period_start AND period_end THEN 1 ELSE 0 END AS "DischRef",
         CASE WHEN discharged IS NULL OR discharged > period_end THEN 1 ELSE 0 END AS "OpenRef",
         CASE WHEN (discharged IS NULL OR discharged > period_end)
               AND (first_contact IS NULL OR first_contact > period_end) THEN 1 ELSE 0 END
           AS "Refwaiting1stcontact",
         CASE WHEN (discharged IS NULL OR discharged > period_end) AND o_orderdate <= period_end
              THEN 1 ELSE 0 END AS "RefwithCarePlanCreated"
  FROM referrals JOIN submissions s ON o_orderkey = s.l_orderkey
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN discharges d ON o_orderkey = d.l_orderkey
  LEFT JOIN latest t ON o_orderkey = t.l_orderkey
  LEFT JOIN nation ON c_nationkey = n_nationkey AND n_name NOT LIKE '%_20'
  LEFT JOIN region ON n_regionkey = r_regionkey)
"""
STATUS = ["NewRef", "OpenRef", "DischRef", "Refwaiting1stcontact", "RefwithCarePlanCreated"]


def base_table(spark, folder):
    """One row per order and month in which a line of it shipped."""
    lines = table(spark, folder, "lineitem", "l_orderkey", "l_shipdate", "l_returnflag", "l_linestatus")
    shipped = as_date("l_shipdate")
    attended = F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F")
    # Lines are summed to one row per order and month; the facts of the whole order are
    # then taken over its months. Day and flag (one character) share one number, so that
    # all aggregates are on plain numbers and stay hash aggregates.
    code = F.unix_date(shipped).cast("long") * (1 << 21) + F.ascii("l_returnflag")
    per_month = lines.groupBy("l_orderkey", month_start(shipped).alias("Month")).agg(
        F.min(F.when(attended, shipped)).alias("contact"),
        F.max(F.when(F.col("l_returnflag") == "N", shipped)).alias("left"),
        F.max(code).alias("code"),
    )
    order = W.partitionBy("l_orderkey")
    submissions = per_month.select(
        "l_orderkey",
        "Month",
        F.min("contact").over(order).alias("first_contact"),
        F.max("left").over(order).alias("discharged"),
        F.char(F.max("code").over(order) % (1 << 21)).alias("latest_flag"),
    )
    nations = table(spark, folder, "nation").where(~F.col("n_name").like("%_20"))
    customers = attach(
        table(spark, folder, "customer"), "c_nationkey", nations, "n_nationkey",
        {"Sub_ICB_Name": "n_name", "n_regionkey": "n_regionkey"},
    )
    customers = attach(
        customers, "n_regionkey", table(spark, folder, "region"), "r_regionkey",
        {"ICB_Name": "r_name"}, default="Other",
    ).withColumn("Sub_ICB_Name", F.coalesce("Sub_ICB_Name", F.lit("Other")))
    orders = table(spark, folder, "orders").withColumn("received", as_date("o_orderdate"))
    base = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(submissions, F.col("o_orderkey") == F.col("l_orderkey"))
        .withColumn("period_end", month_end("Month"))
    )
    status = caseload_flags(
        "received", "discharged", "first_contact", "Month", "period_end", care_plan="received"
    )
    return base.select(
        "Month", "o_orderkey", "Sub_ICB_Name", "ICB_Name",
        F.col("c_mktsegment").alias("Provider_Name"), "c_acctbal", "o_orderstatus",
        "o_orderpriority", "latest_flag",
        wait_days("received", "first_contact", "period_end").alias("wait"),
        in_period("first_contact", "Month", "period_end").alias("SeenNow"),
        *[c.alias(n) for n, c in status.items()],
    )


@query("referral_base", f"WITH {BASE_SQL} SELECT DISTINCT * FROM base")
def referral_base(spark, folder):
    return base_table(spark, folder)


@query(
    "caseload_flags",
    f"""
WITH {BASE_SQL}
SELECT "Month", {", ".join(f'CAST(SUM("{s}") AS BIGINT) AS "{s}"' for s in STATUS)}
FROM base GROUP BY 1
""",
)
def caseload_flags_query(spark, folder):
    return base_table(spark, folder).groupBy("Month").agg(*[F.sum(s).alias(s) for s in STATUS])


BALANCE_BANDS = [Band(None, 0, "Owing"), Band(0, 5000, "Small"), Band(5000, None, "Large")]
GEOGRAPHIES = [
    Geography("Provider", "Provider_Name", {"OrgName": "Provider_Name"}),
    Geography("Sub-ICB", "Sub_ICB_Name", {"OrgName": "Sub_ICB_Name"}),
    Geography("ICB", "ICB_Name", {"OrgName": "ICB_Name"}),
    Geography("National", None, {}, {"OrgName": "All"}),
]
CATEGORIES = [
    ALL,
    Category("Balance", "balance_band"),
    Category("Status", "status_group"),
    Category("Priority", "priority_group"),
]


def _matrix_sql() -> str:
    places = {
        "Provider": '"Provider_Name"',
        "Sub-ICB": '"Sub_ICB_Name"',
        "ICB": '"ICB_Name"',
        "National": "'All'",
    }
    kinds = {
        "Total": "'Total'",
        "Balance": "CASE WHEN c_acctbal <= 0 THEN 'Owing' WHEN c_acctbal BETWEEN 0 AND 5000 "
        "THEN 'Small' WHEN c_acctbal >= 5000 THEN 'Large' ELSE 'Unknown' END",
        "Status": "CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Open' "
        "ELSE 'Other/Not Stated/Not Known' END",
        "Priority": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fast' "
        "WHEN o_orderpriority = '3-MEDIUM' THEN 'Normal' ELSE 'Not Stated/Not Known' END",
    }
    sums = ", ".join(f'CAST(SUM("{s}") AS BIGINT) AS "{s}"' for s in STATUS)
    parts = [
        f"""SELECT "Month", latest_flag, '{place}' AS "Orgtype", {org} AS "OrgName",
                   '{kind}' AS "Category", {value} AS "Variable", {sums}
            FROM base GROUP BY 1, 2, 3, 4, 5, 6"""
        for place, org in places.items()
        for kind, value in kinds.items()
    ]
    return f"WITH {BASE_SQL} " + " UNION ALL ".join(parts)


@query("metric_matrix", _matrix_sql())
def metric_matrix(spark, folder):
    banded = base_table(spark, folder).withColumns(
        {
            "balance_band": band_label("c_acctbal", BALANCE_BANDS, "Unknown"),
            "status_group": group_codes(
                "o_orderstatus", {"Done": ["F"], "Open": ["O"]}, "Other/Not Stated/Not Known"
            ),
            "priority_group": group_codes(
                "o_orderpriority",
                {"Fast": ["1-URGENT", "2-HIGH"], "Normal": ["3-MEDIUM"]},
                "Not Stated/Not Known",
            ),
        }
    )
    return labelled_grouping_sets(
        banded, ["Month", "latest_flag"], GEOGRAPHIES, CATEGORIES, {s: F.sum(s) for s in STATUS},
        additive=True,
    )


@query(
    "local_date",
    """
SELECT CAST(timezone('Europe/London', timezone('UTC', ts)) AS DATE) AS local_day,
       COUNT(*) AS n, MIN(timezone('Europe/London', timezone('UTC', ts))) AS first_ts,
       COUNT(*) FILTER (WHERE timezone('Europe/London', timezone('UTC', ts)) <> ts) AS moved
FROM (SELECT ts FROM events UNION ALL SELECT ts + INTERVAL 182 DAY FROM events)
GROUP BY 1
""",
)
def local_date(spark, folder):
    ts = table(spark, folder, "events", "ts")
    # The same events again in summer time.
    both = ts.unionByName(ts.select((F.col("ts") + F.expr("interval 182 days")).alias("ts")))
    local = both.withColumn("local", local_time("ts", "Europe/London"))
    return local.groupBy(as_date("local").alias("local_day")).agg(
        F.count("*").alias("n"),
        F.min("local").alias("first_ts"),
        F.count_if(F.col("local") != F.col("ts")).alias("moved"),
    )
