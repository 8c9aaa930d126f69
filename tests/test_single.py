"""Repeated keys are errors, and strict sums compare nodes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.operators import compare, cube, formula, lookup, reshape, single, skew
from freshet.plans import diversions, flows, functional, gates, maps
from freshet.plans.disaggregation import regional_share
from freshet.sources import exports

DAY = dt.date(1990, 1, 31)
FLOWS = "scenario string, date date, node string, flow_cfs double"
TERMS = [("m", "P", "num", "A"), ("m", "P", "num", "B")]


def nodes(spark, *names):
    return spark.createDataFrame([("s", DAY, n, v) for n, v in names], FLOWS)


def refused(df):
    with pytest.raises(Exception, match="several rows where one is expected"):
        df.collect()


@pytest.mark.parametrize("strict", [True, False])
def test_formula_sums(spark, strict):
    formulas = formula.formula_frame(spark, TERMS)

    def total(*rows):
        return formula.formula_sums(nodes(spark, *rows), formulas, strict=strict)

    refused(total(("A", 1.0), ("A", 1.0)))
    refused(total(("A", 1.0), ("A", 1.0), ("B", 1.0)))
    refused(total(("A", 1.0), ("A", None)))
    assert total(("A", 1.0), ("B", 2.0)).first()["num"] == 3
    assert total(("A", 1.0), ("B", None)).first()["num"] == (None if strict else 1)
    assert total(("B", 2.0)).first()["num"] == (None if strict else 2)


def test_formulas_as_a_table_of_many_terms(spark):
    terms = [("m", "P", "num", f"n{k}", 1.0) for k in range(100)] + [("m", "Q", "num", "n0", 1.0)]
    table = formula.with_term_counts(spark.createDataFrame(terms, "metric string, place string, role string, node string, weight double"))
    rows = [(f"n{k}", 1.0) for k in range(100)]
    got = {r["place"]: r["num"] for r in formula.formula_sums(nodes(spark, *rows), table).collect()}
    assert got == {"P": 100, "Q": 1}
    got = {r["place"]: r["num"] for r in formula.formula_sums(nodes(spark, *rows[1:], rows[5]).filter("false").union(nodes(spark, *rows[1:])), table).collect()}
    assert got == {"P": None}
    refused(formula.formula_sums(nodes(spark, *rows[1:], rows[5]), table))
    refused(formula.formula_sums(nodes(spark, rows[0], rows[0]), table))
    with pytest.raises(ValueError):
        formula.formula_frame(spark, [t[:4] for t in terms])


def test_overrides(spark):
    base = spark.createDataFrame([("s", DAY, "P", 1.0), ("s", DAY, "Q", 1.0)], "scenario string, date date, place string, flow_cfs double")
    one = spark.createDataFrame([(DAY, 10.0)], "date date, flow_cfs double")
    two = spark.createDataFrame([(DAY, 10.0), (DAY, 20.0)], "date date, flow_cfs double")
    assert {r["place"]: r["flow_cfs"] for r in lookup.replace_series(base, one, "P", ["date"]).collect()} == {"P": 10, "Q": 1}
    refused(lookup.replace_series(base, two, "P", ["date"]))
    refused(lookup.replace_series(base, two.withColumn("scenario", F.lit("s")), "P"))
    refused(skew.per_date(two))
    with pytest.raises(TypeError):
        skew.per_date(one.withColumn("date", F.col("date").cast("string")))
    cells = spark.createDataFrame([("s", 1, "P", 1, 1990, 5.0)], "scenario string, place_order int, place string, month int, year int, value double")
    source = spark.createDataFrame([(1990, 1, 7.0), (1990, 1, 8.0)], "year int, month int, value double")
    assert cube.override_slice(cells, source.limit(1), "P", keys=()).first()["value"] == 7
    refused(cube.override_slice(cells, source, "P", keys=()))
    refused(cube.override_slice(cells, source.withColumn("scenario", F.lit("s")), "P"))
    wide = spark.createDataFrame([(DAY, *([5.0] * (1 + len(maps.DELTA_REACHES))))], ["date", maps.UPPER_SACRAMENTO, *maps.DELTA_REACHES])
    refused(flows.change_upstream(wide, two.withColumnRenamed("flow_cfs", "new_cfs")))


def test_cells_and_comparisons(spark):
    rows = nodes(spark, ("A", 1.0), ("A", 2.0), ("B", 3.0))
    refused(reshape.to_wide(rows, ["scenario"], "node", "flow_cfs", ["A", "B"]))
    assert reshape.to_wide(rows, ["scenario"], "node", "flow_cfs", ["B", "C"]).collect() == [("s", 3.0, None)]
    many = [f"x{k}" for k in range(150)]
    wide = reshape.to_wide(nodes(spark, *((n, float(k)) for k, n in enumerate(many))), ["scenario"], "node", "flow_cfs", many)
    assert list(wide.first())[1:] == [float(k) for k in range(150)]
    refused(reshape.to_wide(nodes(spark, ("x149", 1.0), ("x149", None)), ["scenario"], "node", "flow_cfs", many).select("x149"))
    values = rows.withColumnRenamed("flow_cfs", "value")
    refused(compare.scenario_difference(values, "s", "t", ["date", "node"]))


def test_places_of_which_one_is_picked(spark):
    def placed(*rows):
        return spark.createDataFrame([("s", DAY, p, 1.0) for p in rows], "scenario string, date date, place string, flow_cfs double")

    refused(flows.blend_lower_mid(placed(maps.LOWER_MID[0], maps.LOWER_MID[0], maps.LOWER_MID[1])))
    refused(functional.flow_ratios(placed("a", "b", "b"), "a", "b", 1980, 2000, (1,)))
    east = [(DAY, n, 1.0) for n in [maps.MOKELUMNE_FLOW, *maps.MOKELUMNE_DIVERSIONS]]
    run = spark.createDataFrame([*east, east[1]], "date date, node string, flow_cfs double")
    assert diversions.east_side_diversion(run.dropDuplicates(), 1980, 2000).first()["value"] is not None
    refused(diversions.east_side_diversion(run, 1980, 2000))


def test_windows_over_members(spark):
    members = [("g", "P", "a", "t"), ("g", "Q", "b", "t")]
    whole = nodes(spark, ("a", 1.0), ("b", 3.0), ("t", 8.0))
    assert {r["place"]: r["value"] for r in formula.apportion(whole, members).collect()} == {"P": 2, "Q": 6}
    refused(formula.apportion(nodes(spark, ("a", 1.0), ("a", 1.0), ("t", 8.0)), members))
    streams = [("R", "P", "a", 1.0), ("R", "Q", "b", 1.0)]
    total = nodes(spark, ("a", 1.0), ("b", 3.0), ("R", 8.0))
    assert {r["place"]: r["flow_cfs"] for r in regional_share(total, streams, ()).collect()} == {"P": 2, "Q": 6}
    refused(regional_share(nodes(spark, ("a", 1.0), ("a", 3.0), ("R", 8.0)), streams, ()))


def test_cubes_share_one_rule(spark):
    nan = float("nan")
    series = spark.createDataFrame(
        [("s", DAY, "P", nan), ("s", DAY, "X", 1.0), ("t", DAY, "P", 2.0)], "scenario string, date date, place string, value double"
    )
    places = spark.createDataFrame([("P",), ("Q",)], "place string")
    columns = ["scenario", "place", "month", "year", "value"]
    one = cube.model_cube(series, ["P", "Q"], 1990, 1990, 0.0).select(*columns)
    two = cube.table_cube(series, places, ["s", "t"], 1990, 1990, 0.0).select(*columns)
    assert sorted(one.collect()) == sorted(two.collect()) and one.count() == 48
    assert {r["value"] for r in one.collect() if r["scenario"] == "s"} == {0.0}
    refused(cube.model_cube(series.union(series), ["P"], 1990, 1990))
    refused(cube.table_cube(series.union(series), places, ["s"], 1990, 1990))


def test_gate_log_of_one_day(spark):
    log = [("g", dt.date(2010, 1, 1), 1, "Closed"), ("g", dt.date(2010, 1, 10), 2, "Open"), ("g", dt.date(2010, 1, 10), 3, "Closed")]
    df = spark.createDataFrame(log, "gate string, date date, id int, action string")
    assert [r["days_opened"] for r in gates.gate_intervals(df, order=("date", "id")).collect()] == [0]
    refused(gates.gate_intervals(df))


def test_quoted_commas_and_scenario_names(spark, tmp_path):
    (tmp_path / "scenario=N2").mkdir()
    lines = ["A,,M,M,M", "B,,D1,D2,D3", 'Units,,CFS,CFS,CFS', '1,31Jan1990,"1,000",2,"3"']
    (tmp_path / "scenario=N2" / "x.csv").write_text("\n".join(lines))
    rows = exports.node_export(spark, f"{tmp_path}/scenario=N2/x.csv")
    assert {r["node"]: r["flow_cfs"] for r in rows.collect()} == {"D1": 1000, "D2": 2, "D3": 3}
    tagged = exports.scenario_of_file(rows, {"scenario=N": "N"})
    assert {r["scenario"] for r in tagged.collect()} == {None}
    assert {r["scenario"] for r in exports.scenario_of_file(rows, {"scenario=N2": "N2"}).collect()} == {"N2"}


def test_marks():
    assert formula.marked([("a", 1), ("a", 2), ("b", 3)], 0) == [("a", 1, 1), ("a", 2, 2), ("b", 3, 1)]
    assert single.BITS == 63
