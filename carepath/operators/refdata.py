"""Reference data: current versions, decoding, successor codes, hierarchies.

No join here carries a broadcast hint. Spark broadcasts a reference table when its
statistics say it is small and shuffles otherwise, and adaptive execution splits a
hot code on the fact side, so a table that grows does not break the job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.groups import MISSING
from ..functions.labels import key as text_key
from ..sources.staging import stage
from .guards import watched

_KEY = "__ref_key"


def current(
    df: DataFrame,
    end: str | Sequence[str] | None = "Effective_To",
    flag: tuple[str, object] | None = None,
) -> DataFrame:
    """Rows in force now: open end date(s), or a flag column with the given value."""
    for column in [end] if isinstance(end, str) else end or []:
        df = df.where(F.col(column).isNull())
    if flag is not None:
        df = df.where(F.col(flag[0]) == F.lit(flag[1]))
    return df


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that would multiply facts; a sound reference table has none."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def attach(
    df: DataFrame,
    code: Column | str,
    reference: DataFrame,
    key: str,
    columns: Mapping[str, str],
    default: str | None = None,
    default_when: str = "null",
    collated: bool = False,
    how: str = "left",
) -> DataFrame:
    """Left join on one key, adding ``columns`` (output name -> reference column).

    ``default`` fills each added column where that column is NULL
    (``default_when="null"``), or all of them where no row matched
    (``default_when="unmatched"``). ``collated`` compares keys without regard to
    case and trailing spaces.
    """
    code = F.col(code) if isinstance(code, str) else code
    norm = text_key if collated else (lambda c: c)
    renamed = {out: f"__ref_{i}" for i, out in enumerate(columns)}
    right = reference.select(
        norm(F.col(key)).alias(_KEY),
        *[F.col(src).alias(renamed[out]) for out, src in columns.items()],
    )
    right = watched(right, [_KEY], f"{key} -> {', '.join(columns)}")
    joined = df.join(right, norm(code) == F.col(_KEY), how)
    unmatched = F.col(_KEY).isNull()
    out = {}
    for name, tmp in renamed.items():
        value = F.col(tmp)
        if default is not None and default_when == "unmatched":
            value = F.when(unmatched, F.lit(default)).otherwise(value)
        elif default is not None:
            value = F.coalesce(value, F.lit(default))
        out[name] = value
    return joined.withColumns(out).drop(_KEY, *renamed.values())


def decode(
    df: DataFrame,
    code: str,
    dictionary: DataFrame,
    out: str,
    default: str | None = MISSING,
    key: str = "Main_Code_Text",
    value: str = "Main_Description",
    collated: bool = False,
) -> DataFrame:
    """Dictionary description of a code."""
    return attach(df, code, dictionary, key, {out: value}, default, collated=collated)


def described_once(
    df: DataFrame, codes: Sequence[str], describe: Callable[[DataFrame], DataFrame], source: DataFrame | None = None
) -> DataFrame:
    """df with what ``describe`` adds to its codes, looked up once per combination of codes.

    ``describe`` gets the distinct combinations and joins the reference tables; the rows of
    df meet its result only, in one join. ``source`` is a cheaper frame that has all
    combinations, if there is one. A reference key that repeats multiplies rows as it would
    in a join of its own.

    The result is staged, so its size is known when the rows meet it: Spark broadcasts it
    while it is small, and the rows stay where they are.
    """
    looked_up = stage(describe((df if source is None else source).select(*codes).distinct()), "described")
    tmp = {c: f"__described_{i}" for i, c in enumerate(codes)}
    right = looked_up.withColumnsRenamed(tmp)
    same = [F.col(c).eqNullSafe(F.col(t)) for c, t in tmp.items()]
    return df.join(right, same, "left").drop(*tmp.values())


def numbered(
    df: DataFrame, columns: Sequence[str], number: str, source: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """df with a number in place of the columns, and a staged table of the numbers and what they stand for.

    For columns that come in few combinations, NULLs included: rows that have to move then move
    as numbers, and what is left of them afterwards meets the table again. ``source`` is a cheaper
    frame that has all combinations, if there is one; otherwise df is read twice, so it should be stored.
    """
    found = (df if source is None else source).select(*columns).distinct()
    combinations = stage(found.withColumn(number, F.monotonically_increasing_id()), "numbers")
    tmp = {c: f"__numbered_{i}" for i, c in enumerate(columns)}
    same = [F.col(c).eqNullSafe(F.col(t)) for c, t in tmp.items()]
    return df.join(combinations.withColumnsRenamed(tmp), same).drop(*columns, *tmp.values()), combinations


def resolve_code(
    df: DataFrame,
    code: str,
    changes: DataFrame,
    old: str,
    new: str,
    out: str | None = None,
    collated: bool = False,
) -> DataFrame:
    """Successor of a code, one hop; codes without one stay as they are."""
    found = attach(df, code, changes, old, {"__successor": new}, collated=collated)
    return found.withColumn(out or code, F.coalesce("__successor", F.col(code))).drop("__successor")


def era_key(period: Column | str, cut, before: str, after: str) -> Column:
    """Key column of the era: ``before`` until the cut, ``after`` from it on."""
    period = F.col(period) if isinstance(period, str) else period
    return F.when(period < F.lit(cut), F.col(before)).otherwise(F.col(after))
