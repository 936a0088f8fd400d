"""Month-partitioned tables that change from one version to the next in one step.

A published name is a view. Behind it are generations: tables partitioned by month, each
written once by one refresh and never changed. The view names, for every generation, the
months that are read from it. A refresh writes its months as a new generation and then replaces
the view, which is a single change of the catalog: a reader sees the table before or after it,
and a refresh that breaks off before leaves no trace in what is read. Unchanged months are
neither read nor copied. Generations that neither the view nor the one before it reads are
dropped, so a query that began before the switch can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: View properties: months read from a generation, and months read from it one version earlier.
LIVE, BEFORE = "carepath.months.", "carepath.before."
#: What the writer of a table notes with it; it stays until it is noted anew.
NOTE = "carepath.note."
NO_MONTH = "none"
State = dict[str, list[str]]


def _quoted(name: str) -> str:
    return f"`{name}`"


def _generations(spark: SparkSession, table: str, prefix: str) -> State:
    """Generation -> its months, as the view says."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r.key[len(prefix):]: [m for m in r.value.split(",") if m] for r in rows if r.key.startswith(prefix)}


def notes_of(spark: SparkSession, table: str) -> dict[str, str]:
    """What was noted with the versions of a published table."""
    if not is_versioned(spark, table):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r.key[len(NOTE):]: r.value for r in rows if r.key.startswith(NOTE)}


def is_versioned(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def _partitions(spark: SparkSession, generation: str) -> list[str]:
    """Months of a generation, from the catalog."""
    values = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {generation}").collect()]
    return [NO_MONTH if v in ("__HIVE_DEFAULT_PARTITION__", "null") else v for v in values]


def _write_generation(df: DataFrame, table: str, month: str) -> str:
    generation = f"{table}__{uuid.uuid4().hex[:12]}"
    rest = [c for c in df.columns if c != month]
    (
        # Rows of one month in few files, a large month in several.
        df.hint("rebalance", F.col(month))
        .select(*[_quoted(c) for c in rest], month)
        .write.mode("errorifexists")
        .partitionBy(month)
        .format("parquet")
        .saveAsTable(generation)
    )
    return generation


def _switch(
    spark: SparkSession, table: str, columns: Sequence[str], live: State, before: State, month: str,
    notes: Mapping[str, str],
) -> None:
    """The one step that readers see."""
    shown = ", ".join(map(_quoted, columns))
    parts = []
    for generation, months in live.items():
        dates = ", ".join(f"DATE'{m}'" for m in months if m != NO_MONTH)
        tests = ([f"{_quoted(month)} IN ({dates})"] if dates else []) + ([f"{_quoted(month)} IS NULL"] if NO_MONTH in months else [])
        parts.append(f"SELECT {shown} FROM {generation} WHERE {' OR '.join(tests) or 'false'}")
    read = {**{LIVE + g: m for g, m in live.items()}, **{BEFORE + g: m for g, m in before.items()}}
    noted = {**{k: ",".join(m) for k, m in read.items()}, **{NOTE + k: v for k, v in notes.items()}}
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in noted.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({properties}) AS {' UNION ALL '.join(parts)}")


def _forget(spark: SparkSession, table: str) -> None:
    """Drop generations that neither this version nor the one before reads, broken-off ones included."""
    needed = {*_generations(spark, table, LIVE), *_generations(spark, table, BEFORE)}
    database, _, short = table.rpartition(".")
    names = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{short.lower()}__*'").collect()
    for r in names:
        name = f"{database}.{r.tableName}" if database else r.tableName
        if name.lower() not in {g.lower() for g in needed} and len(r.tableName) == len(short) + 14:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def adopt(spark: SparkSession, table: str, month: str = "Month") -> None:
    """Put a plain table behind a view, if it is one. Frames that read it have to be made anew.

    It is copied first. Between its drop and the view there is no such name: the one step that
    readers can notice, once in the life of a table.
    """
    if not spark.catalog.tableExists(table) or is_versioned(spark, table):
        return
    plain = spark.table(table)
    columns = plain.columns
    generation = _write_generation(plain, table, month)
    spark.sql(f"DROP TABLE {table}")
    _switch(spark, table, columns, {generation: _partitions(spark, generation)}, {}, month, {})


def publish_version(
    new: DataFrame, table: str, month: str = "Month", gone: Iterable[date] = (), whole: bool = False,
    notes: Mapping[str, str] | None = None,
) -> None:
    """The next version: the months of ``new`` replace those of the table, ``gone`` months go.

    With ``whole`` the table is ``new`` and nothing else. ``new`` may read the table, unless it
    is a plain one that was not adopted yet. ``notes`` change in the same step.
    """
    spark = new.sparkSession
    adopt(spark, table, month)
    there = spark.catalog.tableExists(table)
    if there and not whole:
        columns = spark.table(table).columns
        new = new.select(*[_quoted(c) for c in columns])
    else:
        columns = [*[c for c in new.columns if c != month], month]
    before = _generations(spark, table, LIVE) if there else {}
    generation = _write_generation(new, table, month)
    arrived = _partitions(spark, generation)
    out = {*arrived, *(m.isoformat() for m in gone)}
    kept = {} if whole else {g: [m for m in months if m not in out] for g, months in before.items()}
    live = {g: months for g, months in kept.items() if months} | {generation: arrived}
    kept_notes = {} if whole else notes_of(spark, table)
    _switch(spark, table, columns, live, before, month, {**kept_notes, **(notes or {})})
    _forget(spark, table)


def add_rows(df: DataFrame, table: str, month: str = "Month") -> None:
    """The next version with further rows, matched by column name."""
    spark = df.sparkSession
    adopt(spark, table, month)
    current = spark.table(table)
    months = [r[0] for r in df.select(month).distinct().collect()]  # partition values, a handful
    known = [m for m in months if m is not None]
    same = F.col(month).isin(known) if known else F.lit(False)
    touched = current.where(same | F.col(month).isNull() if len(known) < len(months) else same)
    publish_version(touched.unionByName(df.select(*[_quoted(c) for c in current.columns])), table, month)
