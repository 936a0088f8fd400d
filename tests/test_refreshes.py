"""Refresh runs, repeated and broken off."""

import os
from datetime import date as d
from datetime import datetime as t

import pytest

from carepath.functions.dates import Window
from carepath.plans import refreshes
from carepath.plans.admissions import admissions
from carepath.registry.care import pathway_tables
from carepath.registry.domain import activity_tables, splits
from carepath.sources import publish, versions

FOLDER = "/root/testdata/sf0.001"
RUNS = t(2024, 6, 1, 9), t(2024, 7, 1, 9)


def content(df):
    return sorted(map(str, df.drop("SnapshotDate").collect()))


def test_admissions_twice_and_after_a_break(spark, monkeypatch):
    tables, rows = activity_tables(spark, FOLDER), splits(spark)
    names = "refreshed_admissions", "archived_admissions"
    first = refreshes.refresh_admissions(spark, tables, *names, RUNS[0], rows, start_month=d(1996, 1, 1), insert_months=3)
    assert first.insert == Window(d(1996, 1, 1), d(1996, 3, 31))
    whole = refreshes.admissions(tables, first.insert, RUNS[0], rows)
    assert content(spark.table(names[0])) == content(whole.select(*spark.table(names[0]).columns))

    bounds = {"delete_months": 1, "insert_months": 2}
    window = publish.window_of(spark, names[0], **bounds)
    old = content(spark.table(names[0]))

    def broken(*_):
        raise OSError("lost")

    for step in ("_write_generation", "_switch"):
        with monkeypatch.context() as m:
            m.setattr(versions, step, broken)
            with pytest.raises(OSError):
                refreshes.refresh_admissions(spark, tables, *names, RUNS[1], rows, **bounds)
        assert content(spark.table(names[0])) == old
    for _ in range(2):
        assert refreshes.refresh_admissions(spark, tables, *names, RUNS[1], rows, window=window) == window
        want = admissions(tables, Window(d(1996, 1, 1), d(1996, 4, 30)), RUNS[1], rows)
        got = spark.table(names[0])
        assert content(got) == content(want.select(*got.columns))
        old = spark.table(names[1])
        assert {r.Month for r in old.select("Month").distinct().collect()} == {d(1996, 3, 1)}
        assert old.count() == spark.table(names[0]).where("Month = DATE'1996-03-01'").count()


def test_readmissions_and_metrics_twice(spark):
    tables, rows = activity_tables(spark, FOLDER), splits(spark)
    window, seen = None, []
    for _ in range(2):
        window = refreshes.refresh_readmissions(
            spark, tables, "refreshed_readmissions", "archived_readmissions", RUNS[0], rows,
            window=window, start_month=d(1995, 1, 1), insert_months=80,
        )
        seen.append(content(spark.table("refreshed_readmissions")))
    assert seen[0] == seen[1] and seen[0]

    care, window, seen = pathway_tables(spark, FOLDER), None, []
    for _ in range(2):
        window = refreshes.refresh_metrics(
            spark, care, "refreshed_metrics", RUNS[0], window=window, start_month=d(1996, 1, 1), insert_months=2
        )
        seen.append(content(spark.table("refreshed_metrics")))
    assert seen[0] == seen[1] and seen[0]
    both = "refreshed_waits", "refreshed_metrics_of_both"
    staged = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    refreshes.refresh_pathway(spark, care, *both, RUNS[0], start_month=d(1996, 1, 1), insert_months=2)
    assert content(spark.table(both[1])) == seen[0] and spark.table(both[0]).count() > 0
    left = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - staged
    assert not [f for f in left if f.startswith("referral-base")]
    later = refreshes.refresh_metrics(spark, care, "refreshed_metrics", RUNS[1])
    months = {r.Month for r in spark.table("refreshed_metrics").select("Month").distinct().collect()}
    assert later.insert == Window(d(1996, 2, 1), d(1996, 3, 31)) and months == {d(1996, m, 1) for m in (1, 2, 3)}
