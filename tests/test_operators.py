"""Operators: invariants, brute-force checks and options."""

import itertools
import random
from collections import defaultdict
from datetime import date as d
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from carepath.operators.events import earliest_latest, first_row
from carepath.operators.readmissions import lookback_months, readmission_pairs
from carepath.operators.refdata import attach, repeated_keys, resolve_code
from carepath.operators.reshape import pivot_measures, unpivot_groups
from carepath.operators.rollup import ALL, Category, Geography, labelled_grouping_sets, ratio
from carepath.operators.spc import p_chart
from carepath.operators.weights import WEIGHT, reallocate, split_rows
from carepath.sources.tables import distinct_union, era_union, literal_rows

GEO = [
    Geography("Site", "site", {"Org": "site", "Region": "region"}),
    Geography("Region", "region", {"Org": "region"}),
    Geography("All", None, {}, {"Org": "England", "Region": "All Regions"}),
]
CATS = [ALL, Category("Sex", "sex"), Category("Code", "code", ("chapter",))]


def facts(spark, n=400):
    rng = random.Random(1)
    rows = []
    for _ in range(n):
        # One site holds more than a third of all rows.
        site = "s0" if rng.random() < 0.4 else f"s{rng.randrange(1, 6)}"
        code = rng.choice(["a", "b", None])
        rows.append((site, f"r{int(site[1]) % 2}", rng.choice(["1", "2", None]), code,
                     code and code.upper(), rng.randrange(0, 5)))
    return rows, literal_rows(
        spark, rows, "site string, region string, sex string, code string, chapter string, v int"
    )


def brute(rows):
    out = defaultdict(lambda: [0, 0])
    places = {
        "Site": lambda r: (r[0], r[1]), "Region": lambda r: (r[1], None),
        "All": lambda r: ("England", "All Regions"),
    }
    kinds = {
        "Total": lambda r: ("Total", None), "Sex": lambda r: (r[2], None), "Code": lambda r: (r[3], r[4]),
    }
    for r, (level, place), (kind, value) in itertools.product(rows, places.items(), kinds.items()):
        cell = out[(level, *place(r), kind, *value(r))]
        cell[0] += 1
        cell[1] += r[5]
    return dict(out)


@pytest.mark.parametrize("additive", [False, True])
def test_grouping_sets_against_brute_force(spark, additive):
    rows, df = facts(spark)
    got = labelled_grouping_sets(
        df, [], GEO, CATS, {"n": F.count("*"), "v": F.sum("v")}, "Level", additive=additive
    )
    assert got.columns == ["Level", "Org", "Region", "Category", "Variable", "chapter", "n", "v"]
    cells = {(r.Level, r.Org, r.Region, r.Category, r.Variable, r.chapter): [r.n, r.v] for r in got.collect()}
    assert cells == brute(rows)
    # A NULL member is its own row beside the total.
    assert cells["All", "England", "All Regions", "Sex", None, None][0] > 0


def test_p_chart_options(spark):
    pts = literal_rows(
        spark, [("a", 1, 9, 10), ("a", 2, 1, 90), ("b", 1, 5, 4), ("c", 1, 0, 0), (None, 1, 1, 2)],
        "org string, m int, num int, den int",
    )
    got = {(r.org, r.m): r for r in p_chart(pts, ["org"], {"": "num"}, "den", code="org").collect()}
    assert len(got) == 4
    assert got["a", 1].pbar == 0.1 and got["a", 1].LCL < 0
    assert got["b", 1].pbar == 1.25 and got["b", 1].UCL is None
    assert got["c", 1].pbar is None and got["c", 1].UCL is None
    clamped = {(r.org, r.m): r for r in p_chart(pts, ["org"], {"": "num"}, "den", clamp=True).collect()}
    assert clamped["a", 1].LCL == 0.0 and (None, 1) in clamped


def test_reallocation_keeps_totals(spark):
    counts = literal_rows(spark, [("D4U1Y", 100.0), ("A1", 10.0), ("zz", 3.0)], "code string, n double")
    own = literal_rows(
        spark, [("A1", "Alpha", 1.0, "A1", "Alpha", "X", "ICB X", "R", "Region")],
        "SubICB_Code string, SubICB_Name string, PopWeight double, SubICB26_Code string, "
        "SubICB26_Name string, ICB_Code string, ICB_Name string, Region_Code string, Region_Name string",
    )
    out = reallocate(counts, "code", own.unionByName(split_rows(spark)), ["n"]).collect()
    assert len(out) == 5 and sum(r.n for r in out) == pytest.approx(113.0)
    other = [r for r in out if r.code == "zz"][0]
    assert (other.ICB_Code, other.n, other[WEIGHT]) == ("Other", 3.0, 1.0)


def test_readmissions_against_brute_force(spark):
    rng = random.Random(7)
    day0 = d(2023, 1, 1)
    rows = []
    for i in range(300):
        person = rng.choice([0, 0, 0, *range(1, 9)])  # person 0 is a hot key
        adm = day0 + timedelta(rng.randrange(0, 300))
        rows.append((i, None if person == 8 else person, adm, adm + timedelta(rng.randrange(0, 20))))
    df = literal_rows(spark, rows, "id int, person int, adm date, dis date")
    months = [d(2023, m, 1) for m in range(2, 11)]

    def expected(pick):
        out = set()
        for m in months:
            nxt = d(2023, m.month + 1, 1)
            for p in range(8):
                before = [r for r in rows if r[1] == p and m - timedelta(90) <= r[3] < m]
                within = [r for r in rows if r[1] == p and m <= r[2] < nxt]
                if before and within:
                    sign = 1 if pick == "earliest" else -1
                    x = min(before, key=lambda r: (sign * r[3].toordinal(), r[0]))
                    y = min(within, key=lambda r: (r[2], r[0]))
                    out.add((m, p, x[0], y[0], (y[2] - x[3]).days))
        return out

    for pick in ("earliest", "latest"):
        got = readmission_pairs(
            df.drop("adm").withColumnRenamed("id", "x"), df.drop("dis").withColumnRenamed("id", "y"),
            "person", "dis", "adm", months[0], len(months), pick=pick,
            discharge_carry=["x"], admission_carry=["y"],
        )
        assert {(r.Month, r.person, r.x, r.y, r.TimeBetweenAdmissions) for r in got.collect()} == expected(pick)
    with pytest.raises(ValueError):
        readmission_pairs(df, df, "person", "dis", "adm", months[0], pick="middle")


def test_lookback_months(spark):
    days = literal_rows(spark, [(d(2023, 1, 31),), (d(2023, 2, 1),), (d(2023, 12, 31),)], "x date")
    got = [r[0] for r in days.select(lookback_months("x", d(2023, 1, 1), 24)).collect()]
    assert got[0] == [d(2023, 2, 1), d(2023, 3, 1), d(2023, 4, 1), d(2023, 5, 1)]
    assert got[1] == [d(2023, 3, 1), d(2023, 4, 1), d(2023, 5, 1)]
    assert got[2] == [d(2024, 1, 1), d(2024, 2, 1), d(2024, 3, 1)]
    short = [r[0] for r in days.select(lookback_months("x", d(2023, 1, 1), 24, lookback=5)).collect()]
    assert short == [[d(2023, 2, 1)], [], [d(2024, 1, 1)]]


def test_first_last_rows(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 3, "x"), ("a", 3, "y"), ("b", None, "z"), ("b", 2, "w")]
    df = literal_rows(spark, rows, "k string, t int, v string")
    got = {r.k: r for r in earliest_latest(df, ["k"], ["t", "v"], [F.col("t")], [F.col("t")]).collect()}
    assert (got["a"].Earliestv, got["a"].Latestv) == ("x", "y")
    assert (got["b"].Earliestt, got["b"].Latestt) == (None, 2)
    firsts = {r.k: r.v for r in first_row(df, ["k"], [F.col("t")], ["v"]).collect()}
    assert firsts == {"a": "x", "b": "z"}


def test_reference_joins(spark):
    df = literal_rows(spark, [("a ",), ("B",), (None,), ("q",)], "code string")
    ref = literal_rows(spark, [("A", "one", None), ("b", None, "two")], "k string, p string, q string")
    plain = attach(df, "code", ref, "k", {"p": "p"}, default="Other").collect()
    assert {r.code: r.p for r in plain} == {"a ": "Other", "B": "Other", None: "Other", "q": "Other"}
    both = attach(df, "code", ref, "k", {"p": "p", "q": "q"}, "Other", "unmatched", collated=True).collect()
    assert {r.code: (r.p, r.q) for r in both} == {
        "a ": ("one", None), "B": (None, "two"), None: ("Other", "Other"), "q": ("Other", "Other"),
    }
    each = attach(df, "code", ref, "k", {"p": "p", "q": "q"}, "Other", collated=True).collect()
    assert {r.code: (r.p, r.q) for r in each}["B"] == ("Other", "two")
    changes = literal_rows(spark, [("q", "r"), ("r", "s"), ("d", "1"), ("d", "2")], "o string, n string")
    assert {r.code for r in resolve_code(df, "code", changes, "o", "n").collect()} == {"a ", "B", None, "r"}
    assert [(r.o, r.n) for r in repeated_keys(changes, "o").collect()] == [("d", 2)]


def test_reshape_and_unions(spark):
    long = literal_rows(
        spark, [("k", "A", 1.0), ("k", "A", 2.0), ("k", "B", 5.0), ("j", "C", 9.0)], "o string, m string, v double"
    )
    wide = {r.o: (r.A, r.B) for r in pivot_measures(long, "m", "v", ["A", "B"]).collect()}
    assert wide == {"k": (2.0, 5.0), "j": (None, None)}
    table = literal_rows(spark, [("k", 1, None, 3, 4)], "o string, a int, b int, c int, e int")
    rows = unpivot_groups(table, ["o"], {"first": ["a", "b"], "second": ["c", "e"]}, ["x", "y"], "g").collect()
    assert [tuple(r) for r in rows] == [("k", 1, None, "first"), ("k", 3, 4, "second")]
    assert era_union(long, long).count() == 8 and distinct_union(long, long).count() == 4
    assert long.select(ratio(F.col("v"), F.col("v") - F.col("v"))).first()[0] is None


def test_hot_keys_are_bounded(spark):
    from carepath.operators.hotkeys import hot_in_any, hot_keys, is_hot

    df = spark.range(10_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("j"))
    assert sorted(hot_keys(df, "k", 10, least=1), key=str) == [1, 2, None] and hot_keys(df, "j", 10, least=1) == []
    assert hot_keys(df, "k", 10) == [] and hot_keys(df.limit(0), "k", 10) == []
    assert df.where(is_hot("k", [1, None])).count() == 6667 and df.where(is_hot("k", [])).count() == 0
    assert df.where(~is_hot("k", [1])).count() == 6667
    found = hot_in_any({"a": df, "b": df}, {"a": "k", "b": "k"}, 10, least=1)
    assert sorted(found["k"], key=str) == [1, 2, None]


def test_hot_keys_are_told_from_keys_counted_with_them(spark, monkeypatch):
    from carepath.operators import hotkeys

    df = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 800, None).otherwise(F.col("id")).alias("k"))
    for groups in (1, 7, 1 << 16):
        monkeypatch.setattr(hotkeys, "GROUPS", groups)
        assert sorted(hotkeys.hot_keys(df, "k", 10, least=150), key=str) == [1, None]
        assert hotkeys.hot_keys(df, "k", 10, least=600) == []
