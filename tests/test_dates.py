from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.functions import dates as D


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'date' if isinstance(v, dt.date) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).first()[0]


@pytest.mark.parametrize("read,want", [
    ("2021-09-30", "2021-09-30"), ("2021-10-31", "1921-10-31"), ("2021-12-31", "1921-12-31"),
    ("2022-01-31", "1922-01-31"), ("2024-02-29", "1924-02-29"), ("2000-02-29", "2000-02-29"), ("2100-02-28", "2000-02-29"),
])
def test_century_shift(spark, read, want):
    got = one(spark, D.century_shift("d"), d=dt.date.fromisoformat(read))
    assert got == dt.date.fromisoformat(want)


@pytest.mark.parametrize("read,want", [("2003-12-31", "2003-12-31"), ("2004-01-31", "1904-01-31"), ("2022-10-31", "1922-10-31")])
def test_century_shift_after(spark, read, want):
    assert one(spark, D.century_shift_after("d"), d=dt.date.fromisoformat(read)) == dt.date.fromisoformat(want)


@pytest.mark.parametrize("text,want", [("3/15/85", "1985-03-15"), ("11/15/05", "2005-11-15"), ("1/1/69", "1969-01-01"),
                                       ("1/1/68", "2068-01-01"), ("nonsense", None)])
def test_short_years(spark, text, want):
    assert one(spark, D.parse_short_year("t"), t=text) == (want and dt.date.fromisoformat(want))


@pytest.mark.parametrize("text,want", [("31Oct1921", "1921-10-31"), ("28Feb1922", "1922-02-28"), ("CFS", None), ("", None)])
def test_export_dates(spark, text, want):
    assert one(spark, D.parse_date("t", D.EXPORT_DATE), t=text) == (want and dt.date.fromisoformat(want))


@pytest.mark.parametrize("day,want,month,year", [
    ("1999-10-31", "1999-10-31", 1, 2000), ("1999-09-30", "2000-09-30", 12, 1999), ("1996-02-29", "1997-02-28", 5, 1996),
])
def test_water_year(spark, day, want, month, year):
    day = dt.date.fromisoformat(day)
    assert one(spark, D.water_year_shift("d"), d=day) == dt.date.fromisoformat(want)
    assert one(spark, D.water_month("d"), d=day) == month
    assert one(spark, D.water_year("d"), d=day) == year


def test_months(spark):
    assert one(spark, D.month_index("t"), t="September") == 9
    assert one(spark, D.month_index("t"), t="May") == 5
    assert one(spark, D.month_index("t"), t="Month") is None
    assert one(spark, D.month_abb("m"), m=12) == "Dec"
    assert one(spark, D.days_in_plain_month("m"), m=2) == 28
    assert one(spark, D.days_in_month("d"), d=dt.date(2000, 2, 3)) == 29
    assert one(spark, D.month_end_of("y", "m"), y=1996, m=2) == dt.date(1996, 2, 29)


def test_year_window_keeps_both_ends(spark):
    days = [dt.date(1979, 12, 31), dt.date(1980, 1, 31), dt.date(2000, 12, 31), dt.date(2001, 1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.filter(D.in_years("d", 1980, 2000)).orderBy("d").collect()] == days[1:3]
    assert len(D.month_ends(1980, 2000)) == 252


def test_round_half_even(spark):
    assert one(spark, F.bround(F.lit(2.5), 0), m=1) == 2.0
