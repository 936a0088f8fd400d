"""Aggregates over organisation levels and categories in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.groups import TOTAL


class Geography(NamedTuple):
    """An organisation level.

    ``columns`` gives each output column its input column, ``constants`` its fixed
    value; ``key`` is the input column that marks the level and no other (None for
    the level of everything).
    """

    label: str
    key: str | None
    columns: Mapping[str, str] = {}
    constants: Mapping[str, str | None] = {}


class Category(NamedTuple):
    """A breakdown. ``carry`` names columns that go along with it and no other."""

    label: str
    column: str | None
    carry: Sequence[str] = ()


ALL = Category(TOTAL, None)


def _marked(key: str | None) -> Column:
    return F.lit(True) if key is None else F.col(f"__grouping_{key}") == 0


def _pick(items, value) -> Column:
    """First item whose key is grouped by wins; the item without a key comes last."""
    out = F
    for item in sorted(items, key=lambda i: i[0] is None):
        out = out.when(_marked(item[0]), value(item[1]))
    return out


def labelled_grouping_sets(
    df: DataFrame,
    fixed: Sequence[str],
    geographies: Sequence[Geography],
    categories: Sequence[Category],
    aggregates: Mapping[str, Column],
    level: str = "Orgtype",
    category: str = "Category",
    variable: str = "Variable",
    total: str = TOTAL,
    additive: bool = False,
) -> DataFrame:
    """Every geography by every category from a single scan of ``df``.

    Labels come from the grouping indicators, not from NULL tests, so a NULL member
    of a category stays NULL and is not mistaken for the total. Sums are combined
    within each task before the exchange; a level that holds every row costs no
    more to shuffle than one row per task.

    Records pass once per grouping set. With ``additive`` (all aggregates are sums
    or counts) they pass only once per category, at the finest geography, and the
    geographies are made from those sums.
    """
    if additive and len(geographies) > 1:
        places = [c for g in geographies for c in g.columns.values()]
        carried = [c for cat in categories for c in cat.carry]
        finest = category_sums(
            df, list(dict.fromkeys([*fixed, *places])), categories, aggregates,
            "__category", "__variable", total,
        )
        out = geography_sums(
            finest, [*fixed, "__category", "__variable", *dict.fromkeys(carried)], geographies,
            list(aggregates), level,
        )
        places = [c for g in geographies for c in [*g.columns, *g.constants]]
        return out.withColumnsRenamed({"__category": category, "__variable": variable}).select(
            *[
                F.col(f"`{c}`")
                for c in dict.fromkeys(
                    [*fixed, level, *places, category, variable, *carried, *aggregates]
                )
            ]
        )
    sets = []
    for geo in geographies:
        for cat in categories:
            own = [cat.column, *cat.carry] if cat.column else []
            sets.append(list(dict.fromkeys([*fixed, *geo.columns.values(), *own])))
    columns = list(dict.fromkeys(c for one in sets for c in one))
    keys = [g.key for g in geographies if g.key] + [c.column for c in categories if c.column]
    grouped = df.groupingSets(
        [[F.col(f"`{c}`") for c in one] for one in sets], *[F.col(f"`{c}`") for c in columns]
    ).agg(
        *[F.grouping(F.col(f"`{k}`")).alias(f"__grouping_{k}") for k in dict.fromkeys(keys)],
        *[agg.alias(name) for name, agg in aggregates.items()],
    )

    def geo_value(out):
        def value(geo):
            if out in geo.columns:
                return F.col(f"`{geo.columns[out]}`")
            return F.lit(geo.constants.get(out)).cast("string")

        return value

    geos = [(g.key, g) for g in geographies]
    cats = [(c.column, c) for c in categories]
    outs = list(dict.fromkeys(o for g in geographies for o in [*g.columns, *g.constants]))
    carried = list(dict.fromkeys(c for cat in categories for c in cat.carry))
    return grouped.select(
        *[F.col(f"`{c}`") for c in fixed],
        _pick(geos, lambda g: F.lit(g.label)).alias(level),
        *[_pick(geos, geo_value(o)).alias(o) for o in outs],
        _pick(cats, lambda c: F.lit(c.label)).alias(category),
        _pick(
            cats, lambda c: F.col(f"`{c.column}`").cast("string") if c.column else F.lit(total)
        ).alias(variable),
        *[F.col(f"`{c}`") for c in carried],
        *[F.col(f"`{name}`") for name in aggregates],
    )


def category_sums(
    df: DataFrame,
    fixed: Sequence[str],
    categories: Sequence[Category],
    aggregates: Mapping[str, Column],
    category: str = "Category",
    variable: str = "Variable",
    total: str = TOTAL,
) -> DataFrame:
    """Every category at the one geography given by ``fixed``.

    Several rollups that start from this result share its exchange.
    """
    return labelled_grouping_sets(
        df, fixed, [Geography("", None)], categories, aggregates, "__level", category, variable, total
    ).drop("__level")


def geography_sums(
    sums: DataFrame,
    fixed: Sequence[str],
    geographies: Sequence[Geography],
    measures: Sequence[str],
    level: str = "Orgtype",
) -> DataFrame:
    """Sums of a finer level re-summed for each geography."""
    return labelled_grouping_sets(
        sums, fixed, geographies, [ALL], {m: F.sum(F.col(f"`{m}`")) for m in measures},
        level, "__all", "__total",
    ).drop("__all", "__total")


def org_rollup(
    df: DataFrame,
    period: Sequence[str],
    measures: Sequence[str],
    levels: Sequence[Geography],
    ratios: Mapping[str, tuple[str, str]] | None = None,
    national: DataFrame | None = None,
    national_level: Geography | None = None,
    level: str = "Org Type",
) -> DataFrame:
    """Measures re-summed at each organisation level, with ratios of the sums.

    Facts are first summed to the lowest level, whose rows are few, and only those
    go through the grouping sets. ``national`` holds separately published national
    rows: they are summed as they are and are not the sum of the parts.
    """
    leaf = list(dict.fromkeys(c for lv in levels for c in lv.columns.values()))
    sums = {m: F.sum(F.col(f"`{m}`").cast("double")) for m in measures}
    leaves = df.groupBy(*period, *[F.col(f"`{c}`") for c in leaf]).agg(
        *[s.alias(m) for m, s in sums.items()]
    )
    out = geography_sums(leaves, period, levels, measures, level)
    if national is not None:
        lv = national_level
        whole = national.groupBy(*period).agg(*[s.alias(m) for m, s in sums.items()])
        names = [c for c in out.columns if c not in (*period, level, *measures)]
        out = out.unionByName(
            whole.select(
                *period,
                F.lit(lv.label).alias(level),
                *[F.lit(lv.constants.get(c)).cast("string").alias(c) for c in names],
                *[F.col(f"`{m}`") for m in measures],
            )
        )
    for name, (num, den) in (ratios or {}).items():
        out = out.withColumn(name, ratio(num, den))
    return out


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient in double; NULL over zero."""
    num = F.col(f"`{numerator}`") if isinstance(numerator, str) else numerator
    den = F.col(f"`{denominator}`") if isinstance(denominator, str) else denominator
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_of_sums(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(F.sum(numerator), F.sum(denominator))
