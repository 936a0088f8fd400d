"""Registered queries against the same query in SQL, and the shape of their plans."""

import pytest
from oracle import compare, connect

from carepath.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas", "Scan ExistingRDD")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    assert name in ORACLES
    assert compare(df, con, ORACLES[name]) == []


def test_metric_matrix_reads_each_table_once(spark):
    plan = QUERIES["metric_matrix"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 5  # lineitem, orders, customer, nation, region


def test_scans_are_pruned_and_filtered(spark):
    plan = QUERIES["readmissions_monthly"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(o_orderpriority,2)" in plan
    assert "o_totalprice" not in plan


def test_no_join_without_keys_when_nothing_is_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        for key, fn in QUERIES.items():
            plan = fn(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            assert not [node for node in FORBIDDEN if node in plan], key
    finally:
        spark.conf.set(name, before)


def test_first_and_last_rows_of_a_busy_entity(spark):
    """A third of all rows belong to one entity; its first and last rows are still right."""
    from pyspark.sql import functions as F

    from carepath.operators.events import earliest_latest, first_row

    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("who"),
        F.when(F.col("id") % 1000 == 6, None).otherwise((F.col("id") * 7919) % 10_007).alias("day"),
        F.col("id").alias("row"),
    )
    got = earliest_latest(rows, ["who"], ["row", "day"], first=[F.col("day")], last=[F.col("day")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    want = rows.groupBy("who").agg(F.min(F.struct("day", "row")).alias("a"), F.max(F.struct("day", "row")).alias("b"))
    plain = want.select("who", "a.row", "a.day", "b.row", "b.day")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    for one_side in (
        earliest_latest(rows, ["who"], ["row", "day"], first=[F.col("day")]),
        earliest_latest(rows, ["who"], ["row", "day"], last=[F.col("day")]),
        first_row(rows, ["who"], [F.col("day")], ["row"]),
    ):
        plan = one_side._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        # A limit per group below the exchange and one above it.
        assert plan.index(", Final") < plan.index("Exchange") < plan.index(", Partial")
    only = {r.who: r.row for r in first_row(rows, ["who"], [F.col("day")], ["row"]).collect()}
    assert only == {r.who: r.a.row for r in want.collect()}
    newest = earliest_latest(rows, ["who"], ["row"], last=[F.col("day")])
    assert {r.who: r.Latestrow for r in newest.collect()} == {r.who: r.b.row for r in want.collect()}


def test_readmission_pairs_read_each_spell_once_per_side(spark):
    from carepath.registry import QUERIES

    for name in ("readmissions_monthly", "readmissions_latest"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 2
        assert plan.count("WindowGroupLimit") == 4 and plan.count("Join") == 1


def test_admissions_are_summed_before_reference_joins(spark):
    from datetime import date

    from carepath.functions.dates import Window
    from carepath.plans.admissions import episode_sums, spell_sums
    from carepath.registry.domain import activity_tables

    tables = activity_tables(spark, FOLDER)
    for sums in (episode_sums, spell_sums):
        df = sums(tables, Window(date(1996, 1, 1), date(1997, 12, 31)))
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The one join derives the stays from orders and customers.
        assert plan.count("FileScan parquet") == 2 and plan.count("Join ") == 1
        assert "SortAggregate" not in plan
