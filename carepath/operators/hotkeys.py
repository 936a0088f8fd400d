"""Keys with so many rows that they would fill a bucket of a bucketed table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has this many times the rows of an average bucket, and LEAST at least.
SHARE = 1.0
LEAST = 100_000


#: Keys are counted together first, in so many groups: many more than a table has buckets.
GROUPS = 1 << 16


def hot_keys(df: DataFrame, key: str, buckets: int, share: float = SHARE, least: int = LEAST) -> list:
    """Keys of more rows than share times an average bucket: buckets / share of them at most.

    A hot key's group has more rows than that as well, so keys are counted one by one in such
    groups only; in a table without hot keys there are hardly any, and no row per key moves.
    """
    groups = F.pmod(F.xxhash64(key), F.lit(GROUPS))
    sizes = df.groupBy(groups.alias("group")).count()
    total, most = sizes.agg(F.sum("count"), F.max("count")).first()
    limit = max(least, share * (total or 0) / buckets)
    if (most or 0) <= limit:
        return []
    large = sizes.where(F.col("count") > limit).select("group")
    suspects = df.select(F.col(key).alias("key"), groups.alias("group")).join(F.broadcast(large), "group", "left_semi")
    return [r[0] for r in suspects.groupBy("key").count().where(F.col("count") > limit).collect()]


def is_hot(key: str, values: list) -> Column:
    """Whether the key is one of the values; NULL is one if it is among them."""
    known = [v for v in values if v is not None]
    hit = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return hit | F.col(key).isNull() if len(known) < len(values) else hit


def hot_in_any(tables: Mapping[str, DataFrame], keys: Mapping[str, str], buckets: int, **limits) -> dict[str, list]:
    """Hot keys by column: the union over all tables that have the column. keys: table -> column."""
    found: dict[str, list] = {}
    for name, column in keys.items():
        more = hot_keys(tables[name], column, buckets, **limits)
        known = found.setdefault(column, [])
        known += [v for v in more if v not in known]
    return found
