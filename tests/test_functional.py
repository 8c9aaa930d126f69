"""Published numbers and the functional-flow chain."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.functions.units import acre_feet, cfs_to_cms
from freshet.operators import lookup as L
from freshet.operators import stats as S
from freshet.plans import disaggregation as G
from freshet.plans import flows as P
from freshet.plans import functional as E
from freshet.plans import gates, maps

FLOW = "scenario string, date date, node string, flow_cfs double"


@pytest.mark.parametrize("river,kind,year_type,volume", [
    ("Sacramento", "proposed", "Wet", 12578235), ("Sacramento", "natural", "Wet", 16380382),
    ("Sacramento", "proposed", "Dry", 6203089), ("Sacramento", "natural", "Dry", 4967965),
    ("San Joaquin", "proposed", "Wet", 2294932), ("San Joaquin", "natural", "Wet", 8742523),
    ("San Joaquin", "proposed", "Dry", 1827844), ("San Joaquin", "natural", "Dry", 2253457),
])
def test_template_volumes(spark, river, kind, year_type, volume):
    rounded = 0 if (river, kind) == ("San Joaquin", "natural") else None
    t = E.templates(spark, river, kind, rounded).filter(F.col("year_type") == year_type)
    row = S.annual_volume(t, ["year_type"]).first()
    assert row["acre_feet"] == pytest.approx(volume, abs=0.5)
    assert row["acre_feet_text"] == f"{volume:,}"


def test_units(spark):
    row = spark.range(1).select(cfs_to_cms(F.lit(1.0)), acre_feet(F.lit(2.0))).first()
    assert tuple(row) == (0.028316847, 120.7414)


def test_compare_volumes_keeps_three_series(spark):
    one = spark.createDataFrame([(1.0,), (2.0,)], "flow_cfs double")
    out = {r["type"]: r["acre_feet"] for r in E.compare_volumes(one, one, one.limit(1)).collect()}
    assert out["calsim"] == pytest.approx(181.1121) and len(out) == 3


def test_regional_share_example(spark):
    d = dt.date(2014, 11, 30)
    data = [("s", d, "Mokelumne River", 240.7), ("s", d, "Cosumnes River", 269.4 - 240.7), ("s", d, "Eastside", 79.16)]
    out = {r["place"]: r["flow_cfs"] for r in G.regional_share(spark.createDataFrame(data, FLOW)).collect()}
    assert out["Mokelumne River"] == pytest.approx(70.73, abs=0.01)
    assert sum(out.values()) == pytest.approx(79.16)


def test_regional_share_weights_and_clamp(spark):
    d = dt.date(2000, 1, 31)
    red = dict(zip(["Cow Creek", "Cottonwood Creek", "Battle Creek", "Paynes Creek", "I109", "I112"], [1.0, 2.0, 3.0, 4.0, 6.0, 4.0]))
    data = [("s", d, n, v) for n, v in red.items()] + [("s", d, "RedBluff", 200.0)]
    data += [("s", d, "Mokelumne River", 1.0), ("s", d, "Cosumnes River", 1.0), ("s", d, "Eastside", -3.0)]
    out = {r["place"]: r["flow_cfs"] for r in G.regional_share(spark.createDataFrame(data, FLOW)).collect()}
    # The neighbour's half counts for Bear Creek, the whole node for the sum of 20.
    assert out["Bear Creek"] == 30.0 and out["Cow Creek"] == 10.0 and "I112" not in out
    assert out["Mokelumne River"] == 0.0


def test_representative_years(spark, rows):
    data = [("x", 1990 + i, idx, t) for i, (idx, t) in enumerate([(10.0, "Wet"), (8.0, "Above Normal"), (9.5, "Dry"), (5.0, "Critical")])]
    years = spark.createDataFrame(data, "location string, year int, idx double, year_type string")
    near = S.nearest_to_median(years, maps.WET_TYPES)
    assert [(r["year"], r["distance"]) for r in near.collect()] == [(1992, 0.5)]
    assert S.nearest_to_median(years, maps.WET_TYPES, all_classes=False).count() == 0


def test_synthetic_series_and_dry_years(spark, rows):
    data = [("s", 1996, 1.0, "Above Normal"), ("s", 1997, 1.0, "Below Normal"), ("t", 1996, 1.0, "Dry")]
    years = spark.createDataFrame(data, "location string, year int, idx double, year_type string")
    out = E.synthetic_flow(years.filter("location = 's'"), "Sacramento")
    values = {r["date"]: r["new_cfs"] for r in out.collect()}
    assert len(values) == 24 and values[dt.date(1996, 2, 29)] == 40000.0 and values[dt.date(1997, 2, 28)] == 18500.0
    assert rows(E.dry_years(years, "s", 1990, 2000)) == [(1997,)]


def test_survival_thresholds(spark):
    data = [("s", dt.date(1980, 5, 31), "San Joaquin River", 3.0), ("s", dt.date(1980, 5, 31), "Upper-mid Sacramento River", 4.0),
            ("s", dt.date(1980, 8, 31), "San Joaquin River", 99.0), ("s", dt.date(1980, 8, 31), "Upper-mid Sacramento River", 1.0)]
    out = E.survival_thresholds(spark.createDataFrame(data, "scenario string, date date, place string, flow_cfs double"))
    assert [r["scaled_cfs"] for r in out.orderBy("threshold_cfs").collect()] == [3209.0, 8034.0, 17154.0]


def test_change_is_passed_downstream(spark):
    d = dt.date(1980, 1, 31)
    base = {p: 1000.0 for p in P.FLOW_PLACES} | {"Upper-mid Sacramento River": 200.0, "Lower Sacramento River": None}
    flows = spark.createDataFrame([("r", d, p, v) for p, v in base.items()], "scenario string, date date, place string, flow_cfs double")
    new = spark.createDataFrame([(d, 400.0)], "date date, new_cfs double")
    sj = spark.createDataFrame([(d, 7.0)], "date date, new_cfs double")
    out = {r["place"]: r["flow_cfs"] for r in P.eff_flows(flows, new, sj).collect()}
    assert out["Upper Sacramento River"] == 400.0
    assert out["Upper-mid Sacramento River"] == 100.0  # 200 - 600 is negative
    assert out["Lower-mid Sacramento River1"] == 400.0 and out["Lower Sacramento River"] is None
    assert out["San Joaquin River"] == 7.0 and out["Butte Creek"] == 1000.0 and len(out) == 30


def test_splice_has_each_month_once(spark):
    days = [dt.date(y, m, 28) for y in (1990, 1991, 1992) for m in (1, 2)]
    a = spark.createDataFrame([(d, "a") for d in days], "date date, src string")
    b = spark.createDataFrame([(d, "b") for d in days], "date date, src string")
    out = L.splice_by_year(a, b, spark.createDataFrame([(1991,), (1991,)], "year int"))
    assert {(r["date"], r["src"]) for r in out.collect()} == {(d, "a" if d.year == 1991 else "b") for d in days}
    assert out.count() == 6


def test_gate_rules(spark):
    got = {(r["scenario"], r["month"]): (r["days_closed"], r["prop_closed"]) for r in gates.delta_cross_channel_closed(spark).collect()}
    assert len(got) == 48
    assert got["biop_2008_2009", 5] == (20.0, 20 / 31) and got["biop_itp_2018_2019", 5] == (28.0, 28 / 31)
    assert got["LTO_12a", 6] == (8.0, 8 / 30) and got["biop_2008_2009", 2] == (28.0, 1.0)
    assert all(v[1] == 1.0 for k, v in got.items() if k[0] == "run_of_river")


def test_line_fit_and_prediction(spark):
    df = spark.createDataFrame([(15000.0, 1.0), (16000.0, 3.0), (17000.0, 5.0), (100.0, 99.0)], "x double, y double")
    fit = S.fit_line(df.filter(F.col("x") >= 15000), F.col("y"), F.col("x"))
    row = fit.first()
    assert row["slope"] == pytest.approx(0.002) and row["r2"] == pytest.approx(1) and row["n"] == 3
    out = [r["predicted"] for r in S.predict_line(df, fit, F.col("x"), 15000.0).orderBy("x").collect()]
    assert out == pytest.approx([0.0, 1.0, 3.0, 5.0])


def test_merges_and_remap(spark, rows):
    d = dt.date(1990, 1, 31)
    a = spark.createDataFrame([(d, "x", None), (d, "y", 1.0)], "date date, node string, flow_cfs double")
    b = spark.createDataFrame([(d, "x", 5.0), (d, "z", 2.0)], "date date, node string, flow_cfs double")
    assert rows(L.merge_sources([a, b], ["date", "node"]), "node", "flow_cfs") == [("x", None), ("y", 1.0), ("z", 2.0)]
    wide = L.full_merge(a.filter("node = 'y'"), b.filter("node = 'z'").drop("node"), ["date"])
    assert sorted(wide.columns) == ["date", "flow_cfs_x", "flow_cfs_y", "node"]
    calendar = spark.createDataFrame([(dt.date(2014, 10, 1), dt.date(1925, 10, 31)), (dt.date(2014, 11, 1), None)], "cl_date date, cs_date date")
    series = spark.createDataFrame([(dt.date(1925, 10, 1), 7.0)], "date date, flow double")
    assert rows(L.calendar_remap(series, calendar), "cl_date", "flow") == [(dt.date(2014, 10, 1), 7.0), (dt.date(2014, 11, 1), None)]
    assert rows(L.lookup_label(a, {"x": "Ex"}, "node", "label"), "node", "label") == [("x", "Ex"), ("y", None)]


def test_node_crosswalk(spark):
    from freshet.plans.crosswalk import PRODUCTS, crosswalk

    found = {p: {r["place"]: (r["calsim2"], r["calsim3"]) for r in crosswalk(spark, p).collect()} for p in PRODUCTS}
    assert found["flows"]["Mokelumne River"] == (None, "C_CMCHE") and len(found["flows"]) == 30
    assert found["diversions"]["Butte Creek"][0] == "C217B + D217"
    assert found["diversions"]["Deer Creek"][0] == "C11309 / (C11307 + C11309 + C11308) * D11305"
    assert found["diversions"]["Mokelumne River"][0] is None
    assert len(found["bypass"]) == 6 and len(found["delta"]) == 4 and len(found["routing"]) == 7


def test_merge_of_rules_over_one_frame(spark, rows):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("y", None), ("z", 3.0)], "node string, flow_cfs double")
    flow = F.col("flow_cfs")
    merged = L.merge_rules(df, [(F.col("node") == "x", flow), (flow >= 1, flow + 10)], ["node"])
    assert rows(merged) == [("x", 1.0), ("y", 12.0), ("z", 13.0)]


FLOWS = "scenario string, date date, place string, flow_cfs double"


def test_junction_ratio(spark, rows):
    """Hubs of hubs, a place with two junctions, unknown junctions, nulls, other months, every salting."""
    d, other = dt.date(1990, 10, 31), dt.date(1990, 11, 30)
    data = [("S", d, "a", 1.0), ("S", d, "b", 3.0), ("S", d, "hub", 4.0), ("S", d, "sea", 8.0), ("S", d, "lone", 5.0),
            ("S", d, "dry", 1.0), ("S", d, "c", None), ("T", d, "a", 2.0), ("S", other, "a", 9.0), ("S", d, None, 7.0), ("S", d, "set", 0.0)]
    pairs = [("a", "hub"), ("b", "hub"), ("b", "sea"), ("hub", "sea"), ("dry", "nowhere"), ("c", "hub"), ("set", "hub"), (None, "hub"), ("lone", None)]
    flows, junctions = spark.createDataFrame(data, FLOWS), spark.createDataFrame(pairs, "place string, junction string")
    want = [("S", "a", 0.25), ("S", "b", 0.375), ("S", "b", 0.75), ("S", "c", 0.0), ("S", "dry", 0.0), ("S", "hub", 0.5),
            ("S", "lone", 0.0), ("S", "sea", 0.0), ("S", "set", 1.0), ("S", None, 0.0), ("T", "a", 0.0)]
    for salts in (1, 8):
        out = P.junction_ratio(flows, junctions, fixed=["set"], salts=salts)
        assert rows(out, "scenario", "place", "value") == sorted(want, key=lambda r: tuple(str(v) for v in r))
    assert P.junction_ratio(flows.limit(0), junctions).count() == 0
    again = spark.createDataFrame([("S", d, "hub", 1.0)], FLOWS)
    with pytest.raises(Exception, match="several rows"):
        P.junction_ratio(flows.unionByName(again), junctions).collect()
