"""Refresh windows and month-partitioned output tables."""

from datetime import date as d
from datetime import datetime as t

import pytest
from pyspark.sql import functions as F

from carepath.functions.dates import (
    Window,
    end_of_month,
    latest_month,
    months_from,
    refresh_window,
    shift_months,
)
from carepath.operators.refresh import replace_latest, roll
from carepath.sources.publish import (
    append_rows,
    create_table,
    publish_replacing_latest,
    publish_rolling,
    window_of,
)
from carepath.sources.staging import stage
from carepath.sources.tables import catalog_tables, literal_rows


def months(spark, first, n, version):
    rows = [(m, f"org{i}", version) for m in months_from(first, n) for i in range(2)]
    return literal_rows(spark, rows, "Month date, Org string, Version string")


def content(df):
    return {(r.Month, r.Org): r.Version for r in df.collect()}


def test_windows():
    w = refresh_window(d(2024, 3, 1))
    assert w.delete == Window(d(2023, 5, 1), d(2024, 3, 31))
    assert w.insert == Window(d(2023, 5, 1), d(2024, 4, 30))
    assert refresh_window(d(2024, 3, 1), 1, 2).insert == Window(d(2024, 3, 1), d(2024, 4, 30))
    first = refresh_window(None, start_month=d(2020, 4, 1))
    assert first.insert == Window(d(2020, 4, 1), d(2021, 3, 31))
    assert first.delete.last < first.delete.first
    with pytest.raises(ValueError):
        refresh_window(None)
    assert shift_months(d(2024, 1, 31), 1) == d(2024, 2, 29)
    assert shift_months(d(2024, 3, 31), -13) == d(2023, 2, 28)
    assert end_of_month(d(2023, 2, 3)) == d(2023, 2, 28)


def test_roll_frames(spark):
    old, new = months(spark, d(2023, 1, 1), 14, "old"), months(spark, d(2022, 1, 1), 40, "new")
    table, archived = roll(old, new, refresh_window(latest_month(old, "Month")))
    got = content(table)
    assert table.count() == len(got) == 30
    assert {m for (m, _), v in got.items() if v == "old"} == set(months_from(d(2023, 1, 1), 3))
    assert {m for (m, _), v in got.items() if v == "new"} == set(months_from(d(2023, 4, 1), 12))
    assert archived.count() == 22
    swapped = content(replace_latest(old, new, Window(d(2024, 2, 1), d(2024, 3, 31))))
    assert swapped[d(2024, 2, 1), "org0"] == swapped[d(2024, 3, 1), "org1"] == "new"
    assert len(swapped) == 30


def test_publish_rolling(spark):
    table, archive = "rolling_out", "rolling_out_archive"
    first = window_of(spark, table, start_month=d(2023, 1, 1), insert_months=14)
    publish_rolling(months(spark, d(2022, 1, 1), 60, "old"), table, archive, first, t(2024, 3, 5))
    assert spark.table(table).count() == 28 and not spark.catalog.tableExists(archive)
    window = window_of(spark, table)
    assert window.insert == Window(d(2023, 4, 1), d(2024, 3, 31))
    # A month inside the window has no new rows and so must go.
    new = months(spark, d(2022, 1, 1), 60, "new").where("Month <> DATE'2023-06-01'")
    for _ in range(2):  # a repeated run with the same window changes nothing
        publish_rolling(new, table, archive, window, t(2024, 4, 5))
        got = content(spark.table(table))
        assert {m for (m, _), v in got.items() if v == "old"} == set(months_from(d(2023, 1, 1), 3))
        assert {m for (m, _), v in got.items() if v == "new"} == set(months_from(d(2023, 4, 1), 12)) - {
            d(2023, 6, 1)
        }
    kept = spark.table(archive)
    assert kept.count() == 22 and {r.Version for r in kept.collect()} == {"old"}
    assert set(catalog_tables(spark, {"x": table})["x"].columns) == {"Month", "Org", "Version"}


def test_archive_keeps_first_run(spark):
    table, archive = "kept_out", "kept_archive"
    create_table(months(spark, d(2023, 1, 1), 14, "old"), table)
    window = window_of(spark, table)
    publish_rolling(months(spark, d(2023, 1, 1), 30, "new"), table, archive, window, t(2024, 4, 5))
    archived = spark.table(archive)
    assert archived.count() == 22 and {r.Version for r in archived.collect()} == {"old"}
    nxt = window_of(spark, table)
    publish_rolling(months(spark, d(2023, 1, 1), 30, "newer"), table, archive, nxt, t(2024, 5, 5))
    assert spark.table(archive).count() == 44
    assert spark.table(archive).where("ArchivedRun LIKE '2024-05%'").select("Version").distinct().first()[0] == "new"


def test_publish_replacing_latest(spark):
    table = "latest_out"
    create_table(months(spark, d(2023, 1, 1), 3, "old"), table)
    new = months(spark, d(2023, 1, 1), 12, "new")
    for _ in range(2):
        publish_replacing_latest(new, table, Window(d(2023, 3, 1), d(2023, 4, 30)))
        got = content(spark.table(table))
        assert {m.month: v for (m, _), v in got.items()} == {1: "old", 2: "old", 3: "new", 4: "new"}
    append_rows(months(spark, d(2023, 9, 1), 1, "extra").select("Version", "Month", "Org"), table)
    assert content(spark.table(table))[d(2023, 9, 1), "org0"] == "extra"


def test_stage(spark):
    df = stage(months(spark, d(2023, 1, 1), 2, "x"), "months")
    assert df.count() == 4
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") in df.inputFiles()[0]


@pytest.mark.parametrize("kind", ["rolling", "latest", "append", "whole"])
@pytest.mark.parametrize("step", ["_write_generation", "_partitions", "_switch", "_forget"])
def test_a_break_at_any_step_leaves_the_old_table_or_the_new(spark, monkeypatch, kind, step):
    from carepath.sources import versions

    table = f"broken_{kind}{step}"
    create_table(months(spark, d(2023, 1, 1), 4, "old"), table)
    new = months(spark, d(2023, 1, 1), 12, "new")
    window = window_of(spark, table, delete_months=2, insert_months=3)
    act = {
        "rolling": lambda: publish_rolling(new, table, f"{table}_archive", window, t(2024, 3, 5)),
        "latest": lambda: publish_replacing_latest(new, table, Window(d(2023, 4, 1), d(2023, 5, 31))),
        "append": lambda: append_rows(months(spark, d(2023, 4, 1), 1, "extra").withColumn("Org", F.lit("z")), table),
        "whole": lambda: create_table(new, table),
    }[kind]
    old = sorted(map(tuple, spark.table(table).collect()))
    reader = spark.table(table)  # planned before the switch, run after it
    for after in (False, True):
        kept = getattr(versions, step)

        def breaks(*args, after=after, kept=kept):
            if after:
                kept(*args)
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(versions, step, breaks)
            with pytest.raises(OSError):
                act()
        seen = sorted(map(tuple, spark.table(table).collect()))
        switched = step == "_forget" or (step == "_switch" and after)
        assert (seen == old) != switched
        assert sorted(map(tuple, reader.collect())) == old
        if switched:
            break
    if kind != "append":  # run again: as if it had not been broken off
        act()
        got = content(spark.table(table))
        fresh = {"rolling": {3, 4, 5}, "latest": {4, 5}, "whole": set(range(1, 13))}[kind]
        assert {m.month for (m, _), v in got.items() if v == "new"} == fresh
    names = [x.name for x in spark.catalog.listTables() if x.name.startswith(f"{table}__")]
    assert len(names) <= 4


def test_versions_keep_unchanged_months_where_they_are(spark):
    from carepath.sources import versions

    table = "kept_months"
    months(spark, d(2023, 1, 1), 3, "plain").write.partitionBy("Month").saveAsTable(table)  # a table from before
    no_month = months(spark, d(2023, 1, 1), 1, "none").withColumn("Month", F.lit(None).cast("date"))
    append_rows(no_month, table)
    publish_replacing_latest(months(spark, d(2023, 3, 1), 2, "new"), table, Window(d(2023, 3, 1), d(2023, 4, 30)))
    assert versions.is_versioned(spark, table)
    assert sorted((str(k[0]), v) for k, v in content(spark.table(table)).items() if k[1] == "org0") == [
        ("2023-01-01", "plain"), ("2023-02-01", "plain"), ("2023-03-01", "new"), ("2023-04-01", "new"), ("None", "none"),
    ]
    files = spark.table(table).where("Month = DATE'2023-01-01'").inputFiles()
    publish_replacing_latest(months(spark, d(2023, 4, 1), 1, "newer"), table, Window(d(2023, 4, 1), d(2023, 4, 30)))
    assert spark.table(table).where("Month = DATE'2023-01-01'").inputFiles() == files
    # A filter on the month reads one month.
    plan = spark.table(table).where("Month = DATE'2023-01-01'")
    assert len(plan.inputFiles()) == len(files) and plan.count() == 2
    publish_replacing_latest(months(spark, d(2023, 4, 1), 1, "x").limit(0), table, Window(d(2023, 4, 1), d(2023, 4, 30)))
    assert {k[0] for k in content(spark.table(table))} == {d(2023, 1, 1), d(2023, 2, 1), d(2023, 3, 1), None}
