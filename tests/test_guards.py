"""Repeated keys of reference tables are reported by every job."""

from datetime import date as d
from datetime import datetime as t

import pytest
from test_pathway import MONTHS
from test_pathway import tables as pathway

from carepath.operators.guards import KeyGuard, Repeat
from carepath.operators.refdata import attach
from carepath.plans.admissions import admissions
from carepath.plans.diagnosis_rate import diagnosis_rate
from carepath.plans.population import population_table
from carepath.plans.prescribing import prescribing
from carepath.plans.readmissions import readmissions
from carepath.plans.referral_pathway import main_metrics, referral_base
from carepath.registry.care import CENSUS, population_tables
from carepath.registry.dashboards import ERA
from carepath.registry.dashboards import window as admitted
from carepath.registry.domain import activity_tables, prescribing_tables, rate_tables, splits
from carepath.sources.tables import literal_rows

FOLDER = "/root/testdata/sf0.001"
RUN = t(2024, 6, 1, 9)


def doubled(tables, name):
    """The tables with the first row of one of them twice."""
    return {**tables, name: tables[name].unionByName(tables[name].orderBy(*tables[name].columns[:1]).limit(1))}


def rates(spark):
    return rate_tables(spark, FOLDER), "ccg_lookup", "IC_CCG", lambda x: diagnosis_rate(x, split=ERA)


def proportions(spark):
    return prescribing_tables(spark, FOLDER), "ccg_lookup", "IC_CCG", prescribing


def metrics(spark):
    return pathway(spark), "commissioner_code_changes", "Org_Code", lambda x: main_metrics(referral_base(x, MONTHS), RUN)


def stays(spark):
    return activity_tables(spark, FOLDER), "provider_successor", "Prov_original", lambda x: admissions(x, admitted(x), RUN, splits(spark))


def returns(spark):
    return activity_tables(spark, FOLDER), "provider_successor", "Prov_original", lambda x: readmissions(x, d(1996, 1, 1), RUN, 3, splits=splits(spark))


def people(spark):
    return population_tables(spark, FOLDER), "commissioner_hierarchy", "Organisation_Code", lambda x: population_table(x, CENSUS)


@pytest.mark.parametrize("job", [rates, proportions, metrics, stays, returns, people])
def test_every_job_reports_a_repeated_code(spark, job):
    tables, name, key, run = job(spark)
    with KeyGuard() as guard:
        sound = run(tables)
    want = sorted(map(str, sound.collect()))
    clean = {k: v for k, v in guard.repeated.items() if k.startswith(key)}
    assert clean == {} and guard.watched
    assert sorted(map(str, run(tables).collect())) == want  # unguarded, the same rows
    with KeyGuard() as guard:
        out = run(doubled(tables, name))
    assert out.columns
    found = {k: v for k, v in guard.repeated.items() if k.startswith(key)}
    assert found and all(v.rows == 2 and v.example for v in found.values())


def test_a_guard_raises_names_the_key_and_ignores_null(spark):
    facts = literal_rows(spark, [("a ",), ("b",)], "code string")
    ref = literal_rows(spark, [("A", "one"), ("a", "two"), ("b", "x"), (None, "y"), (None, "z")], "k string, v string")
    with KeyGuard("raise"), pytest.raises(ValueError, match="repeated key of k -> v: A"):
        attach(facts, "code", ref, "k", {"v": "v"}, collated=True)
    with KeyGuard() as guard:
        out = attach(facts, "code", ref, "k", {"v": "v"}, collated=True)
    assert out.count() == 3 and guard.repeated == {"k -> v": Repeat(2, "A")}
    assert KeyGuard.active == []
    with pytest.raises(ValueError):
        KeyGuard("shrug")
