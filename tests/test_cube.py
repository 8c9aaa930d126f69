from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freshet.functions.dates import month_ends
from freshet.operators import cube as C
from freshet.operators import lots
from freshet.operators.reshape import month_year_matrix, split_list, take_prefix, union_named, union_rules, year_month_matrix

PLACES = ["b", "a", "none"]
SCHEMA = "scenario string, place string, date date, value double"


@pytest.fixture
def series():
    rng = random.Random(1)
    return [(s, p, d, float(i)) for s in ("u", "v") for p in ("a", "b") for i, d in enumerate(month_ends(1979, 1983)) if rng.random() < 0.9]


def test_cube_is_complete_and_ordered(spark, series):
    df = spark.createDataFrame(series, SCHEMA)
    known = {(s, p, d.month, d.year): v for s, p, d, v in series}
    cells = C.model_cube(df, PLACES, 1980, 1982).collect()
    assert len(cells) == 2 * 3 * 12 * 3
    for r in cells:
        assert r["value"] == known.get((r["scenario"], r["place"], r["month"], r["year"]))
        assert r["place_order"] == PLACES.index(r["place"]) + 1
    checked = {r["scenario"]: r for r in C.completeness(C.model_cube(df, PLACES, 1980, 1982), 3, 3).collect()}
    gaps = sum(1 for r in cells if r["scenario"] == "u" and r["value"] is None)
    assert checked["u"]["complete"] and checked["u"]["n_missing"] == gaps
    assert all(r["value"] is not None for r in C.model_cube(df, PLACES, 1980, 1982, fill=0.0).collect())


def test_fill_counts_nan_as_missing(spark):
    df = spark.createDataFrame([("u", "a", dt.date(1980, 1, 31), math.nan)], SCHEMA)
    first = lambda c: c.filter((F.col("month") == 1) & (F.col("place") == "a")).first()["value"]
    assert first(C.model_cube(df, ["a"], 1980, 1980, fill=0.0)) == 0.0
    assert math.isnan(first(C.model_cube(df, ["a"], 1980, 1980)))


def test_boolean_cube(spark):
    df = spark.createDataFrame([("u", "a", dt.date(1980, 1, 31), True)], "scenario string, place string, date date, value boolean")
    values = [r["value"] for r in C.model_cube(df, ["a"], 1980, 1980).orderBy("month").collect()]
    assert values == [True] + [None] * 11


def test_duplicate_cells_are_refused(spark):
    df = spark.createDataFrame([("u", "a", dt.date(1980, 1, 31), 1.0), ("u", "a", dt.date(1980, 1, 30), 2.0)], SCHEMA)
    with pytest.raises(PySparkException):
        C.model_cube(df, ["a"], 1980, 1980).collect()


def test_table_cube_agrees_with_literal_cube(spark, series, rows):
    df = spark.createDataFrame(series, SCHEMA)
    places = spark.createDataFrame([(p,) for p in PLACES], "place string")
    a = C.table_cube(df, places, ["u", "v"], 1980, 1982, 0.0)
    b = C.model_cube(df, PLACES, 1980, 1982, 0.0)
    columns = ["scenario", "place", "month", "year", "value"]
    assert rows(a, *columns) == rows(b, *columns)


def test_nested_round_trip(spark, series, rows):
    cube = C.model_cube(spark.createDataFrame(series, SCHEMA), PLACES, 1980, 1982)
    nested = C.nest(cube)
    first = nested.first()["values"]
    assert len(first) == 12 and all(len(m) == 3 for m in first)
    columns = ["scenario", "place", "month", "year", "value"]
    assert rows(C.unnest(nested), *columns) == rows(cube, *columns)


def test_override_and_splice(spark, series):
    cube = C.model_cube(spark.createDataFrame(series, SCHEMA), PLACES, 1980, 1982, 0.0)
    source = spark.createDataFrame([(1980, 1, -5.0)], "year int, month int, value double")
    for r in C.override_slice(cube, source, "a", keys=()).collect():
        if r["place"] == "a":
            assert r["value"] == (-5.0 if (r["year"], r["month"]) == (1980, 1) else None)
        else:
            assert r["value"] is not None
    years = spark.createDataFrame([(1981,), (1950,)], "year int")
    out = C.splice_years(cube, cube.withColumn("value", F.lit(-1.0)), years)
    assert out.count() == cube.count()
    assert {r["year"] for r in out.filter(F.col("value") == -1).collect()} == {1981}


def test_grid_has_every_cell_once(spark):
    places = spark.createDataFrame([("a",), ("b",)], "place string")
    cells = C.grid(places, ["u", "v"], 1980, 1982)
    assert cells.count() == cells.distinct().count() == 2 * 2 * 12 * 3


def test_matrices(spark):
    df = spark.createDataFrame([("u", dt.date(1980, 1, 31), 1.0), ("u", dt.date(1981, 1, 31), 2.0), ("u", dt.date(1979, 1, 31), 9.0)],
                               "scenario string, date date, x double")
    assert tuple(month_year_matrix(df, "x", [1980, 1981]).first()) == ("u", 1, 1.0, 2.0)
    out = {r["year"]: r["m1"] for r in year_month_matrix(df, "x", [1980, 1981]).collect()}
    assert out == {1980: 1.0, 1981: 2.0}


def test_small_reshapes(spark, rows):
    df = spark.createDataFrame([("p", "D109, D112,  D128, "), ("q", "NA")], "place string, nodes string")
    assert rows(split_list(df, "nodes", "node"), "place", "node") == [("p", "D109"), ("p", "D112"), ("p", "D128")]
    wide = spark.createDataFrame([(1, 2.0)], "k int, `div_Upper-mid River` double")
    assert take_prefix(wide, "div_", ["k"]).columns == ["k", "Upper-mid River"]
    both = union_named(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, 3)], "a int, b int"))
    assert rows(both) == [(1, None), (2, 3)]


def test_parts_of_one_frame(spark, rows):
    df = spark.createDataFrame([("A", 1.0), ("N", 2.0), ("R", None), (None, 4.0)], "s string, v double")
    parts = [(F.col("s") != "R", {}), (F.col("v") >= 2, {"w": F.col("v") * 2, "v": F.col("v") + 1})]
    assert rows(union_rules(df, parts), "s", "v", "w") == [
        ("A", 1.0, None), ("N", 2.0, None), ("N", 3.0, 4.0), (None, 5.0, 8.0),
    ]
    assert union_rules(df.limit(0), parts).columns == ["s", "v", "w"]


def test_a_growing_place_table_is_dealt_to_bounded_lots(spark, monkeypatch):
    """However few partitions the places have, no task holds much more than a lot of cells."""
    monkeypatch.setattr(lots, "PER_LOT", 1000)
    places = spark.range(2000).select(F.col("id").alias("place")).coalesce(1)
    series = spark.createDataFrame([("A", dt.date(2000, 1, 31), 5, 7.0), ("A", dt.date(2000, 2, 29), 9999, 1.0)], "scenario string, date date, place long, value double")
    cube = C.table_cube(series, places, ["A"], 2000, 2000, 0.0)
    tasks = [r["count"] for r in cube.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(tasks) == 24000 and max(tasks) <= 3000
    assert [tuple(r) for r in cube.filter("value <> 0").collect()] == [("A", 5, 1, 2000, 7.0)]
    with pytest.raises(Exception, match="several rows"):
        C.table_cube(series.union(series), places, ["A"], 2000, 2000).collect()
