"""Sums kept per month: built once, replaced, added to, and what outputs make of them."""

from datetime import date as d
from datetime import datetime as t

import pytest
from pyspark.sql import functions as F

from carepath.functions.dates import Window, month_start
from carepath.operators.states import merge_sums, months_in, runs_of, sum_by
from carepath.plans import refreshes
from carepath.plans.admissions import admission_sums, admissions
from carepath.plans.referral_pathway import main_metrics, referral_base
from carepath.registry.care import pathway_tables
from carepath.registry.domain import activity_tables, splits
from carepath.sources import versions
from carepath.sources.states import SumStore
from carepath.sources.tables import literal_rows, parquet

FOLDER = "/root/testdata/sf0.001"
RUN = t(2024, 6, 1, 9)


def content(df):
    return sorted(map(str, df.drop("SnapshotDate").collect()))


def sums(spark, *rows):
    return literal_rows(spark, rows, "Month date, org string, n long, value double")


def store(name, count="n"):
    return SumStore(name, ["org"], ["n", "value"], count=count)


def test_months_and_their_runs():
    assert months_in(Window(d(2023, 11, 1), d(2024, 1, 31))) == [d(2023, 11, 1), d(2023, 12, 1), d(2024, 1, 1)]
    assert months_in(Window(d(2024, 1, 1), d(2023, 12, 31))) == []
    got = runs_of([d(2024, 1, 1), d(2023, 12, 1), d(2024, 3, 1), d(2024, 1, 1)])
    assert got == [Window(d(2023, 12, 1), d(2024, 1, 31)), Window(d(2024, 3, 1), d(2024, 3, 31))]
    assert runs_of([]) == []


def test_merge_has_null_keys_and_drops_what_is_taken_back(spark):
    jan, feb = d(2024, 1, 1), d(2024, 2, 1)
    old = sums(spark, (jan, None, 2, 5.0), (jan, "a", 1, 1.0), (feb, "a", 3, 3.0), (None, "a", 1, 1.0))
    new = sums(spark, (jan, None, 1, 1.0), (jan, "a", -1, -1.0), (feb, "b", 1, None), (None, "a", 1, 2.0))
    got = {(r.Month, r.org): (r.n, r.value) for r in merge_sums(old, new, ["org"], ["n", "value"], count="n").collect()}
    assert got == {(jan, None): (3, 6.0), (feb, "a"): (3, 3.0), (feb, "b"): (1, None), (None, "a"): (2, 3.0)}
    assert merge_sums(old, new, ["org"], ["n", "value"]).count() == 5
    empty = old.limit(0)
    assert merge_sums(empty, empty, ["org"], ["n", "value"], count="n").count() == 0
    assert merge_sums(old, empty, ["org"], ["n", "value"]).schema == old.schema


def test_store_builds_missing_months_only_and_knows_empty_ones(spark):
    kept, asked = store("store_built"), []

    def build(window):
        asked.append(window)
        return sums(spark, *[(m, "a", 1, 1.0) for m in months_in(window) if m != d(2024, 2, 1)])

    spring = Window(d(2024, 1, 1), d(2024, 3, 31))
    assert kept.update(spark, build, spring) == months_in(spring) and asked == [spring]
    assert kept.update(spark, build, spring) == [] and len(asked) == 1
    later = Window(d(2024, 2, 1), d(2024, 5, 31))
    assert kept.update(spark, build, later, changed=[d(2024, 2, 9), d(2020, 1, 1)]) == [d(2024, 2, 1), d(2024, 4, 1), d(2024, 5, 1)]
    assert asked[1:] == [Window(d(2024, 2, 1), d(2024, 2, 29)), Window(d(2024, 4, 1), d(2024, 5, 31))]
    assert kept.built(spark) == set(months_in(Window(d(2024, 1, 1), d(2024, 5, 31))))
    assert {r.Month for r in kept.rows(spark).collect()} == {d(2024, m, 1) for m in (1, 3, 4, 5)}
    plan = kept.rows(spark, Window(d(2024, 4, 1), d(2024, 4, 30)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-04-01" in plan


def test_batches_are_added_once_also_after_a_break(spark, monkeypatch):
    kept = store("store_added")
    jan, feb, mar = d(2024, 1, 1), d(2024, 2, 1), d(2024, 3, 1)
    with pytest.raises(ValueError):
        kept.add(sums(spark, (jan, "a", 1, 1.0)), "b0")
    kept.replace(sums(spark, (jan, "a", 1, 1.0), (feb, "a", 2, 2.0), (mar, "a", 9, 9.0)), [jan, feb])
    late = sums(spark, (feb, "a", 1, 0.5), (feb, "a", 1, 0.5), (feb, "b", 1, 1.0))
    before = content(kept.rows(spark))
    assert len(before) == 2  # a month that was not named is not stored

    def broken(*_):
        raise OSError("lost")

    for step in ("_write_generation", "_switch"):
        with monkeypatch.context() as m:
            m.setattr(versions, step, broken)
            with pytest.raises(OSError):
                kept.add(late, "b1")
        assert content(kept.rows(spark)) == before and not kept.batches(spark)
    assert [kept.add(late, "b1"), kept.add(late, "b1")] == [True, False]
    got = {(r.Month, r.org): (r.n, r.value) for r in kept.rows(spark).collect()}
    assert got == {(jan, "a"): (1, 1.0), (feb, "a"): (4, 3.0), (feb, "b"): (1, 1.0)}
    assert kept.add(sums(spark, (feb, "b", -1, -1.0)), "b2") and kept.rows(spark).count() == 2
    assert kept.add(sums(spark, (jan, "a", -1, -1.0)), "b3")  # the last row of its month
    assert [r.Month for r in kept.rows(spark).collect()] == [feb] and kept.built(spark) == {jan, feb}
    assert kept.batches(spark) == {"b1", "b2", "b3"}
    with pytest.raises(ValueError):
        kept.add(sums(spark, (mar, "a", 1, 1.0)), "b4")
    with pytest.raises(ValueError):
        kept.add(late, "it's")


def test_a_month_added_to_is_the_month_built_anew(spark):
    lines = parquet(spark, FOLDER, "lineitem").select(
        month_start("l_shipdate").alias("Month"), F.col("l_suppkey").cast("string").alias("org"),
        F.lit(1).cast("long").alias("n"), F.col("l_quantity").cast("double").alias("value"), "l_linenumber",
    )
    months = Window(d(1995, 1, 1), d(1995, 6, 30))
    inside = lines.where(F.col("Month").between(*months))
    kept, late = store("store_lines"), F.col("l_linenumber") > 4
    part = sum_by(inside.where(~late), ["org"], ["n", "value"])
    kept.replace(part, months_in(months))
    kept.add(inside.where(late).drop("l_linenumber"), "late-lines")
    whole = sum_by(inside, ["org"], ["n", "value"])
    assert content(kept.rows(spark).select(whole.columns)) == content(whole)


def test_admissions_refreshed_from_stored_sums(spark):
    tables, rows = activity_tables(spark, FOLDER), splits(spark)
    kept = refreshes.admission_store("store_admissions")
    names = "stored_admissions", "stored_admissions_archive"
    first = Window(d(1996, 1, 1), d(1996, 4, 30))
    seen = []

    def build(window):
        seen.append(window)
        return admission_sums(tables, window)

    kept.update(spark, build, Window(first.first, d(1996, 2, 29)))
    kept.update(spark, build, first)
    assert seen == [Window(d(1996, 1, 1), d(1996, 2, 29)), Window(d(1996, 3, 1), d(1996, 4, 30))]
    # What is read of the records is within the two months: the bounds reach the scan.
    plan = admission_sums(tables, seen[1])._jdf.queryExecution().optimizedPlan().toString()
    assert "1996-03-01" in plan and "1996-04-30" in plan and "1996-02-29" not in plan
    want = admissions(tables, first, RUN, rows)
    assert content(admissions(tables, first, RUN, rows, sums=kept.rows(spark, first))) == content(want)

    got = refreshes.refresh_admissions_stored(
        spark, tables, kept, *names, RUN, rows, start_month=d(1996, 1, 1), insert_months=3, changed=[d(1996, 2, 1)]
    )
    assert got.insert == Window(d(1996, 1, 1), d(1996, 3, 31))
    for _ in range(2):
        window = refreshes.refresh_admissions_stored(
            spark, tables, kept, *names, RUN, rows, delete_months=1, insert_months=2
        )
    assert window.insert.last == d(1996, 5, 31) and max(kept.built(spark)) == d(1996, 5, 1)
    whole = admissions(tables, Window(d(1996, 1, 1), d(1996, 5, 31)), RUN, rows)
    out = spark.table(names[0])
    assert content(out) == content(whole.select(out.columns))


def test_metrics_refreshed_from_stored_sums(spark):
    care, kept = pathway_tables(spark, FOLDER), refreshes.metric_store("store_metrics")
    refreshes.refresh_metrics_stored(
        spark, care, kept, "stored_metrics", RUN, start_month=d(1996, 1, 1), insert_months=2
    )
    refreshes.refresh_metrics_stored(spark, care, kept, "stored_metrics", RUN)
    whole = main_metrics(referral_base(care, Window(d(1996, 1, 1), d(1996, 3, 31))), RUN)
    out = spark.table("stored_metrics")
    assert content(out) == content(whole.select(out.columns))
    assert kept.built(spark) == {d(1996, m, 1) for m in (1, 2, 3)}
