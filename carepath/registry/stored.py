"""Outputs from sums kept per month, as refreshes make them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import Window, month_start
from ..operators.rollup import Geography, geography_sums
from ..operators.states import merge_sums, sum_by
from ..plans.admissions import admission_sums, admissions
from ..plans.referral_pathway import metric_sums, metrics_from_sums
from ..sources.staging import stage
from .base import ORACLES, query, table
from .care import base, months_of
from .dashboards import RUN, window
from .domain import activity_tables, splits


def _cut(months: Window) -> tuple[Window, Window]:
    """The months up to the last two, and these."""
    newer = (months.last.replace(day=1) - timedelta(days=1)).replace(day=1)
    return Window(months.first, newer - timedelta(days=1)), Window(newer, months.last)


@query("admissions_from_states", ORACLES["admissions_dashboard"])
def admissions_from_states(spark, folder):
    """Two months are built from records; all earlier ones come from sums written before."""
    tables = activity_tables(spark, folder)
    months = window(tables)
    older, newer = _cut(months)
    stored = stage(admission_sums(tables, older), "admission-states")
    return admissions(tables, months, RUN, splits(spark), sums=stored.unionByName(admission_sums(tables, newer)))


@query("metrics_from_states", ORACLES["referral_metrics_table"])
def metrics_from_states(spark, folder):
    """The metric matrix from stored sums and those of the last two months."""
    records, (older, newer) = base(spark, folder), _cut(months_of(spark, folder))

    def part(months: Window) -> DataFrame:
        return metric_sums(records.where(F.col("Month").between(*months)), stored=True)

    stored = stage(part(older), "metric-states")
    return metrics_from_sums(stored.unionByName(part(newer)), RUN)


MEASURES = ["n", "quantity"]
LEVELS = [
    Geography("Nation", "n_name", {"Org": "n_name"}),
    Geography("Region", "r_name", {"Org": "r_name"}),
    Geography("All", None, {}, {"Org": "All"}),
]


@query(
    "states_late_rows",
    """
WITH kept AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, n_name, r_name, l_returnflag, l_quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE l_linestatus <> 'F' OR l_linenumber <> 1)
SELECT m AS "Month", l_returnflag, t AS "Orgtype", o AS "Org", COUNT(*) AS n, CAST(SUM(l_quantity) AS DOUBLE) AS quantity
FROM (SELECT *, 'Nation' AS t, n_name AS o FROM kept UNION ALL SELECT *, 'Region', r_name FROM kept
      UNION ALL SELECT *, 'All', 'All' FROM kept)
GROUP BY 1, 2, 3, 4
""",
)
def states_late_rows(spark, folder):
    """Stored sums of the first three lines of an order, later lines added, some first lines taken back."""
    lines = table(
        spark, folder, "lineitem", "l_shipdate", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity"
    )

    def sums(rows: DataFrame, sign: int = 1) -> DataFrame:
        return sum_by(
            rows.select(
                month_start("l_shipdate").alias("Month"), "l_suppkey", "l_returnflag",
                F.lit(sign).cast("long").alias("n"), (sign * F.col("l_quantity")).cast("double").alias("quantity"),
            ),
            ["l_suppkey", "l_returnflag"], MEASURES,
        )

    late, keys = F.col("l_linenumber") > 3, ["l_suppkey", "l_returnflag"]
    withdrawn = (F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "F")
    stored = stage(sums(lines.where(~late)), "line-states")
    delta = sums(lines.where(late)).unionByName(sums(lines.where(withdrawn), -1))
    merged = merge_sums(stored, delta, keys, MEASURES, count="n")
    places = (
        table(spark, folder, "supplier", "s_suppkey", "s_nationkey")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "n_name", "r_name")
    )
    placed = merged.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return geography_sums(placed, ["Month", "l_returnflag"], LEVELS, MEASURES)
