"""First, last and first-qualifying events per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _fields(prefix: str, columns: Sequence[Column]) -> list[Column]:
    return [c.alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def _limited(df: DataFrame, keys: Sequence[str], order: Sequence[Column], carry: Sequence[str], latest: bool) -> DataFrame:
    """The first (or last) row of each entity.

    Spark plans a filter on the row number as a limit per group on both sides of the one
    exchange, so no partition sends more than a row per entity, however many it has.
    """
    columns = [*order, *[F.col(c) for c in carry]]
    by = [c.desc_nulls_last() if latest else c.asc_nulls_first() for c in columns]
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return ranked.where("__rank = 1").drop("__rank")


def earliest_latest(
    df: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    first: Sequence[Column] | None = None,
    last: Sequence[Column] | None = None,
    names: tuple[str, str] = ("Earliest", "Latest"),
) -> DataFrame:
    """The earliest and the latest row of each entity, side by side.

    ``first`` is ordered so that the wanted row is smallest, ``last`` so that it is
    greatest, NULL being smaller than all else; the carried columns break ties. Both come
    out of one aggregate, which leaves a row per entity and partition before the exchange;
    one alone is a limit per group.
    """
    if not (first or last) or not carry:
        raise ValueError("name an order and the columns to carry")
    if not (first and last):
        name = names[0] if first else names[1]
        found = _limited(df, keys, first or last, carry, latest=not first)
        return found.select(*keys, *[F.col(c).alias(f"{name}{c}") for c in carry])
    aggs, out = [], []
    for side, order, pick in ((names[0], first, F.min), (names[1], last, F.max)):
        aggs.append(pick(F.struct(*_fields("o", order), *[F.col(c).alias(c) for c in carry])).alias(f"__{side}"))
        out += [F.col(f"__{side}.{c}").alias(f"{side}{c}") for c in carry]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *out)


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], carry: Sequence[str]
) -> DataFrame:
    """One row per key, the smallest by ``order``; carried columns break ties."""
    return _limited(df, keys, order, carry, latest=False).select(*keys, *carry)


def first_event(
    df: DataFrame, keys: Sequence[str], date: str, where: Column | None = None, out: str | None = None
) -> DataFrame:
    """Earliest qualifying date per entity; entities with none are absent."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(F.min(date).alias(out or date))


def primary_secondary(
    primary: DataFrame,
    secondary: DataFrame,
    keys: Sequence[str],
    include_secondary_only: bool = False,
    position: str = "Position",
) -> DataFrame:
    """Distinct primary rows, marked as such.

    A secondary row never shows beside a primary one of the same key, so the plain
    form needs no join. ``include_secondary_only`` adds secondary rows whose key has
    no primary row.
    """
    out = primary.withColumn(position, F.lit("Primary"))
    if include_secondary_only:
        alone = secondary.join(primary.select(*keys).distinct(), list(keys), "left_anti")
        out = out.unionByName(alone.withColumn(position, F.lit("Secondary")))
    return out.distinct()
