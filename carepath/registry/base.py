"""Registered queries: each is a Spark callable with, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..sources.staging import StagedRun, version
from ..sources.tables import parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = parquet(spark, folder, name)
    return df.select(*columns) if columns else df


_RUNS: dict[str, StagedRun] = {}


def session_run(spark: SparkSession) -> StagedRun:
    """The run whose tables last as long as the driver, or until release()."""
    return _RUNS.setdefault(spark.sparkContext.applicationId, StagedRun(spark))


def shared_key(spark: SparkSession, folder: str, name: str, inputs: tuple[str, ...]) -> tuple:
    """Key of a table built from the input files as they are now."""
    return folder, name, tuple(version(spark, f"{folder}/{t}.parquet") for t in inputs)


def shared(spark: SparkSession, folder: str, name: str, inputs: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries of this driver read: built once for given input files.

    It is removed when the driver ends, or by release().
    """
    return session_run(spark).table(shared_key(spark, folder, name, inputs), build, name)


def release(spark: SparkSession) -> None:
    """Remove the tables of the session's run."""
    run = _RUNS.pop(spark.sparkContext.applicationId, None)
    if run is not None:
        run.close()


def orders_per_customer_month(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    """Order counts by status, per customer and month.

    Summed before the join with customers: a customer with a third of all orders
    becomes one row per month.
    """
    status = F.col("o_orderstatus")
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey", month_start("o_orderdate").alias("Month"), *by)
        .agg(
            F.count("*").alias("n"),
            F.count_if(status == "F").alias("n_f"),
            F.count_if(status == "P").alias("n_p"),
            F.count_if(status == "O").alias("n_o"),
        )
    )


def orders_per_nation_month(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    customers = table(spark, folder, "customer", "c_custkey", "c_nationkey")
    counts = (
        orders_per_customer_month(spark, folder, *by)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "Month", *by)
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_f", "n_p", "n_o")])
    )
    return counts.join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).drop("c_nationkey")


# The same in SQL, as a common table expression.
NATION_MONTH_SQL = """
nation_month AS (
  SELECT n_nationkey, n_name, n_regionkey,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS "Month",
         COUNT(*) AS n,
         COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
         COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
         COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_o
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)
"""
