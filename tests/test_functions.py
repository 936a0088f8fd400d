"""Column functions on edge values."""

from datetime import date as d
from datetime import datetime as t

import pytest
from pyspark.sql import functions as F

from carepath.functions import codes
from carepath.functions.bands import AGE_BANDS, AGE_UNKNOWN, STAY_BANDS, band_flags, band_label
from carepath.functions.caseload import caseload_flags, wait_days
from carepath.functions.codes import COHORT_CODES, COHORT_PREFIXES, flag_codes, in_codes
from carepath.functions.dates import days_between, in_range, local_time, month_end, month_start
from carepath.functions.disclosure import display, round_count, suppressed
from carepath.functions.groups import CENSUS_ETHNIC_MEASURES, CENSUS_ETHNIC_PATTERNS
from carepath.functions.labels import code_title, group_text, key, recode, recode_or_keep
from carepath.sources.tables import literal_rows


def column(spark, dtype, values, expr):
    df = literal_rows(spark, [(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_dates(spark):
    late = t(2024, 2, 29, 23, 59, 59)
    df = literal_rows(spark, [(late, d(2024, 1, 31))], "ts timestamp_ntz, day date")
    row = df.select(
        month_start("ts"), month_end("ts"), days_between("day", "ts"), days_between("ts", "day"),
        in_range("ts", d(2024, 2, 1), d(2024, 2, 29)),
        local_time("ts", "Europe/London"), local_time(F.lit(t(2024, 7, 1, 23, 30)), "Europe/London"),
        local_time("ts", None),
    ).first()
    assert tuple(row) == (
        d(2024, 2, 1), d(2024, 2, 29), 29, -29, True, late, t(2024, 7, 2, 0, 30), late,
    )


def test_bands_and_waits(spark):
    ages = column(spark, "int", [0, 64, 65, 74, 75, 84, 85, 120, None], band_label("x", AGE_BANDS, AGE_UNKNOWN))
    assert ages == ["Under65"] * 2 + ["65to74"] * 2 + ["75to84"] * 2 + ["85+"] * 2 + [AGE_UNKNOWN]
    stays = column(spark, "int", [0, 1, 2, 3, 4, 10, 11, 21, 22, None], band_label("x", STAY_BANDS))
    assert [s and s.split()[0] for s in stays] == ["1", "1", "Between", "Between", "Between", "Between", "Between", "Between", "More", None]
    flags = band_flags("x", "C", requires="i", total="Any")
    got = column(spark, "int", [0, 42, 43, 126, 127, None], F.struct(*flags.values()))
    assert [tuple(g) for g in got] == [
        (1, 0, 0, 1), (1, 0, 0, 1), (0, 1, 0, 1), (0, 1, 0, 1), (0, 0, 1, 1), (0, 0, 0, 0),
    ]
    ends = [d(2024, 1, 9), d(2024, 1, 10), d(2024, 3, 31), d(2024, 4, 1), None]
    waits = column(spark, "date", ends, wait_days(F.lit(d(2024, 1, 10)), "x", F.lit(d(2024, 3, 31))))
    assert waits == [None, 0, 81, None, None]


def test_caseload(spark):
    start, end = F.lit(d(2024, 5, 1)), F.lit(d(2024, 5, 31))
    rows = [
        (d(2024, 5, 1), None, None, None),
        (d(2024, 4, 30), d(2024, 5, 31), None, d(2024, 5, 1)),
        (d(2024, 5, 31), d(2024, 6, 1), d(2024, 5, 31), d(2024, 5, 31)),
        (d(2024, 1, 1), None, d(2024, 6, 1), d(2024, 6, 1)),
    ]
    df = literal_rows(spark, rows, "r date, x date, c date, p date")
    flags = caseload_flags("r", "x", "c", start, end, "p")
    assert list(flags) == ["NewRef", "DischRef", "OpenRef", "Refwaiting1stcontact", "RefwithCarePlanCreated"]
    assert [tuple(r) for r in df.select(*flags.values()).collect()] == [
        (1, 0, 1, 1, 0), (0, 1, 0, 0, 0), (1, 0, 1, 0, 1), (0, 0, 1, 1, 0),
    ]


def test_codes(spark):
    assert len(COHORT_CODES) == len(set(COHORT_CODES)) == 143
    texts = ["||F000||X", "F0281", "f000", "F03", "G318", "F067", "F059", "", None]
    got = column(
        spark, "string", texts,
        F.struct(flag_codes("x", codes.CONDITION_IN_SPELL), flag_codes("x", codes.MCI_IN_SPELL),
                 flag_codes("x", codes.DELIRIUM_IN_SPELL)),
    )
    assert [tuple(g) for g in got] == [
        (1, 0, 0), (1, 0, 0), (0, 0, 0), (1, 0, 0), (0, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0), (0, 0, 0),
    ]
    coded = ["F00.0", "F03ABC", "E00..%", "E00..1", "4169750 07", "F99", None]
    exact = column(spark, "string", coded, in_codes("x", COHORT_CODES, COHORT_PREFIXES))
    assert exact == [True, True, True, False, True, False, None]
    wild = column(spark, "string", coded, in_codes("x", COHORT_CODES, COHORT_PREFIXES, wildcards=True))
    assert wild == [True, True, True, True, True, False, None]


def test_labels(spark):
    assert column(spark, "string", ["a", "b", None], recode("x", {"a": "A"})) == ["A", None, None]
    assert column(spark, "string", ["a", "b", None], recode_or_keep("x", {"a": "A"})) == ["A", "b", None]
    assert column(spark, "string", ["ab  ", " AB", None], key("x")) == ["AB", " AB", None]
    assert column(spark, "string", ["t", None], code_title(F.lit("F03"), "x")) == ["F03: t", None]
    groups = column(
        spark, "string", [*CENSUS_ETHNIC_MEASURES, "none"], group_text("x", CENSUS_ETHNIC_PATTERNS, "?")
    )
    assert groups == ["Asian", "Black", "Mixed", "Other", "White", "?"]


def test_display(spark):
    numbers = [0.0, 6.999, 7.0, 7.5, 12345678.4, -2.5, None]
    assert column(spark, "double", numbers, suppressed("x")) == ["*", "*", "7", "8", "12345678", "*", None]
    assert column(spark, "double", numbers, round_count("x")) == [0, 7, 7, 8, 12345678, -3, None]
    assert column(spark, "double", [7.25, None], display("x", 1)) == ["7.3", None]
    plain = column(spark, "double", [7.0, 12345678.0, 0.5, 100.0, 10.25, -3.0, None], display("x", None))
    assert plain == ["7", "12345678", "0.5", "100", "10.25", "-3", None]
    assert column(spark, "long", [6, 7], suppressed("x", threshold=5, mark="-")) == ["6", "7"]


@pytest.mark.parametrize("bad", [{}])
def test_recode_needs_entries(spark, bad):
    with pytest.raises(ValueError):
        recode(F.lit("a"), bad)
