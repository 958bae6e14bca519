"""Literal edge rows for the null, rounding and text rules (FIXTURES.md part C)."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from branchlens.functions import semantics as S


def col(spark, values, ddl, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_not_cancelled_keeps_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "canceled boolean")
    assert df.filter(S.not_cancelled("canceled")).count() == 2


def test_round_half_even_units(spark):
    assert col(spark, [0.5, 1.5, 2.5, -0.5], "double", lambda c: S.round_half_even(c, 0)) == [0.0, 2.0, 2.0, -0.0]


def test_round_two_digits_matches_numpy(spark):
    xs = [0.545, 0.575, 1.015, 1.035] + [i / 1000 for i in range(0, 3000, 5)]
    got = col(spark, xs, "double", lambda c: S.round_half_even(c, 2))
    assert got == [float(np.rint(x * 100) / 100) for x in xs]


def test_sum_of_all_nulls_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "x decimal(18,2)")
    assert df.agg(S.sum_or_zero("x")).first()[0] == 0


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (15.0, 10.0)], "cur double, prev double")
    assert [r[0] for r in df.select(S.growth_pct("cur", "prev")).collect()] == [None, 50.0]


def test_currency(spark):
    got = col(spark, ["AR$ 1.234,50", "", "abc", None, "AR$ 12,5"], "string", S.parse_currency)
    assert got == [1234.5, 0.0, 0.0, None, 12.5]


def test_day_first_dates(spark):
    got = col(spark, ["3/1/2025", "03/01/2025", "31/02/2025", "x", None], "string", S.parse_day_first_date)
    assert got == [dt.date(2025, 1, 3), dt.date(2025, 1, 3), None, None, None]
    edge = [" 3/1/2025", "3/1/2025 ", "  3/1/2025", "3/1/25", "3-1-2025", "29/2/2024", "29/2/2023", "3/ 1/2025"]
    got = col(spark, edge, "string", S.parse_day_first_date)
    assert got == [dt.date(2025, 1, 3), None, None, None, None, dt.date(2024, 2, 29), None, None]


def test_guests(spark):
    assert col(spark, ["12", "7.9", "x", None], "string", S.coerce_int) == [12, 7, 0, 0]


def test_title_case(spark):
    got = col(spark, ["o'brien AND-co 3d", None, "ÁNGEL josé"], "string", S.title_case)
    assert got == ["O'Brien And-Co 3D", None, "Ángel José"]
    assert "o'brien AND-co 3d".title() == got[0]


def test_truncate_name(spark):
    a20, a21 = "a" * 20, "b" * 21
    assert col(spark, [a20, a21, None], "string", S.truncate_name) == [a20, "b" * 20 + "...", None]


def test_strip_zone_keeps_wall_clock(spark):
    got = col(spark, ["2025-01-03T23:30:00-03:00", "2025-01-03T23:30:00Z", "2025-01-03T23:30:00.5+05:30"],
              "string", S.strip_zone)
    assert got == [dt.datetime(2025, 1, 3, 23, 30), dt.datetime(2025, 1, 3, 23, 30),
                   dt.datetime(2025, 1, 3, 23, 30, 0, 500000)]
    days = col(spark, ["2025-01-03T23:30:00-03:00"], "string", lambda c: S.day_of(S.strip_zone(c)))
    assert days == [dt.date(2025, 1, 3)]


def test_month_shifts(spark):
    df = spark.createDataFrame([(dt.date(1998, 7, 31),), (dt.date(1998, 3, 1),), (dt.date(1999, 1, 31),)], "d date")
    rows = df.select(S.shifted_month("d", -30), S.month_of("d"), S.shifted_month("d", 30),
                     S.previous_calendar_month("d")).collect()
    assert [tuple(r) for r in rows] == [
        ("1998-07", "1998-07", "1998-08", "1998-06"),   # 31st: previous == current
        ("1998-01", "1998-03", "1998-03", "1998-02"),   # 1 March: next == current
        ("1999-01", "1999-01", "1999-03", "1998-12"),   # 31 January: +30 days skips February
    ]


def test_numeric_id(spark):
    got = col(spark, ["12", "x1", None, "007", "12.5", "1e3", "9007199254740993"], "string", S.numeric_id)
    assert got == [12, None, None, 7, 12, 1000, 9007199254740993]
