"""Reading inputs: table scans, literal rows and eras of one collection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Tables = Mapping[str, DataFrame]


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: parquet(spark, folder, name) for name in names}


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """Logical name -> catalog name (one, two or three parts)."""
    return {name: spark.table(full) for name, full in names.items()}


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few rows written in code.

    Built from Arrow, so Spark knows their size and plans them as a broadcast
    side by itself.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [() for _ in arrow]
    arrays = [pa.array(list(values), field.type) for values, field in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def era_union(*eras: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Successive collections of one measure as one table, by column name; keeps duplicates."""
    parts = [era.select(*columns) for era in eras] if columns else list(eras)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_union(*parts: DataFrame) -> DataFrame:
    """Union by position, with the first part's column names and no repeated rows."""
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def month_spine(spark: SparkSession, first, count: int, column: str = "Month") -> DataFrame:
    """One row per month; every month is present even where no fact is."""
    return spark.range(count).select(
        F.add_months(F.lit(first), F.col("id").cast("int")).alias(column)
    )
