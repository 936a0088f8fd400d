"""Registry of this subpackage's queries and helpers shared by its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: White space that separates words, inside a character class.
SPACE = r"\x20\x09-\x0D"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def words(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space. NULL has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, also where lambdas use it per element."""
    return F.get(F.transform(F.array(value), body), 0)


def named_apart(df: DataFrame, *names: str) -> dict[str, str]:
    """A column name for each of names that no column of df has, ignoring case."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        free = f"__{name}"
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        out[name] = free
    return out
