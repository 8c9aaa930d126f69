"""All published datasets of all scenarios, built from small made runs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from freshet.checks.views import family_codes, tags
from freshet.plans import catalogue, maps
from freshet.sources import store

FIRST, LAST = 1979, 2002
FLOW = "scenario string, date date, node string, flow_cfs double"


@pytest.fixture(scope="module")
def runs(spark):
    flow = F.round(F.pmod(F.xxhash64("scenario", "node", "date"), F.lit(997)).cast("double"), 0)

    def run(scenarios, codes):
        nodes = spark.createDataFrame([(s, n) for s in scenarios for n in codes], "scenario string, node string")
        return nodes.withColumn("date", F.explode(F.expr("sequence(date'1979-01-01', date'2002-12-01', interval 1 month)"))).withColumn(
            "date", F.last_day("date")).withColumn("flow_cfs", flow).select("scenario", "date", "node", "flow_cfs")

    older, newer = family_codes("calsim2"), family_codes("calsim3")
    node_flow = run(catalogue.OLDER_RUNS, older).unionByName(run([catalogue.NEWER_RUN], newer))
    east = run(catalogue.OLDER_RUNS, [maps.MOKELUMNE_FLOW, *maps.MOKELUMNE_DIVERSIONS])
    extra = [(n, "prop_diversion", "x") for n in dict.fromkeys(t[3] for t in maps.diversion_terms("action_5"))]
    extra += [("C_SJR070", "vernalis_flow", "x"), ("C_SJR053A", "stockton_flow", "x"), ("D1", "cvp_exports_realized", "x"),
              ("D2", "swp_exports_realized", "x"), ("C_SAC195", "bypass_ratio", "x")]
    extra += [(n, "bypass_ratio", "x") for row in maps.OVERTOPPED_NODES for n in maps.nodes(row[2])]
    tag_frame = spark.createDataFrame(tags() + extra, "node string, dataset string, region string")
    codes = sorted({t[0] for t in tags() + extra})
    tagged = run([catalogue.TAGGED_RUN], codes).join(tag_frame, "node")
    rng = random.Random(4)
    years = spark.createDataFrame(
        [(v, y, float(rng.randrange(1, 9)), rng.choice([*maps.WET_TYPES, *maps.DRY_TYPES]))
         for v in ("Sacramento Valley", "San Joaquin Valley") for y in range(1922, 2004)],
        "location string, year int, idx double, year_type string")
    frames = [f.cache() for f in (node_flow, east, tagged, years)]
    return catalogue.Runs(*frames)


@pytest.fixture(scope="module")
def published(runs, spark, tmp_path_factory):
    """Every dataset written once; tests read them back."""
    root = str(tmp_path_factory.mktemp("published"))
    catalogue.publish_all(runs, root)
    return lambda name: store.lookup(spark, root, name)


def scenarios(df):
    return {r[0] for r in df.select("scenario").distinct().collect()}


CUBES = {
    "total_diverted": 31, "proportion_diverted": 31, "mean_flow": 31, "delta_inflow": 2, "delta_proportion_diverted": 2,
    "delta_total_diverted": 2, "proportion_flow_bypasses": 2, "gates_overtopped": 2,
}


@pytest.mark.parametrize("dataset", sorted(CUBES))
def test_cubes(published, dataset):
    df = published(dataset)
    sizes = {r["scenario"]: r["count"] for r in df.groupBy("scenario").count().collect()}
    assert set(sizes) == set(maps.AVAILABLE[dataset])
    for s, n in sizes.items():
        assert n == CUBES[dataset] * 12 * (22 if s == "action_5" else 21)
    assert df.select("scenario", "place", "month", "year").distinct().count() == sum(sizes.values())
    if dataset.startswith("proportion"):
        bounded = df.filter(~F.col("place").isin("Mokelumne River", "Yuba River", "Stanislaus River", "Sutter Bypass"))
        assert bounded.filter((F.col("value") > 1) | (F.col("value") < 0)).count() == 0


@pytest.mark.parametrize("dataset", ["upper_sacramento_flows", "san_joaquin_flows", "wilkins_flow", "freeport_flow",
                                     "vernalis_flow", "stockton_flow", "cvp_exports", "swp_exports"])
def test_matrices(published, dataset):
    df = published(dataset)
    sizes = {r["scenario"]: r["count"] for r in df.groupBy("scenario").count().collect()}
    assert sizes == {s: 12 for s in maps.AVAILABLE[dataset]}
    assert df.filter(F.col("y1980").isNull() | F.col("y2000").isNull()).count() == 0


@pytest.mark.parametrize("dataset", ["flows_cfs", "bypass_flows", "delta_flows", "delta_cross_channel_closed",
                                     "hatchery_oct_nov_flows", "hatchery_apr_may_flows"])
def test_availability(published, dataset):
    assert scenarios(published(dataset)) == set(maps.AVAILABLE[dataset])


def test_flows(runs, published):
    flows = published("flows_cfs")
    n = {r["scenario"]: r["n"] for r in flows.groupBy("scenario").agg(F.countDistinct("place").alias("n")).collect()}
    assert n == {s: 29 if s == "action_5" else 30 for s in maps.FAMILIES}
    # The spliced scenario is the functional-flow one in dry years and the newer run otherwise.
    dry = {r["year"] for r in catalogue._dry(runs).collect()}
    pick = lambda s: {(r["date"], r["place"]): r["flow_cfs"] for r in flows.filter(F.col("scenario") == s).collect()}
    spliced, eff, newer = pick("LTO_12a_eff_dy"), pick("eff"), pick("LTO_12a")
    assert len(spliced) == 30 * 12 * (LAST - FIRST + 1)
    for key, v in spliced.items():
        assert v == (eff if key[0].year in dry else newer)[key]


def test_natal_and_pulse(published):
    natal = published("proportion_flow_natal")
    assert scenarios(natal) == set(maps.AVAILABLE["proportion_flow_natal"])
    assert natal.count() == 6 * 31 * 22
    fixed = natal.filter(F.col("place").isin(list(maps.NATAL_FIXED)))
    assert {r[0] for r in fixed.select("value").distinct().collect()} == {1.0}
    assert natal.filter(F.col("place").isin(*maps.BYPASSES) & (F.col("value") != 0)).count() == 0
    pulse = published("proportion_pulse_flows")
    assert scenarios(pulse) == set(maps.AVAILABLE["proportion_pulse_flows"])
    assert pulse.count() == 7 * 31 * 12
    assert pulse.filter((F.col("scenario") == "action_5") & F.col("value").isNull()).count() == 0


def test_pulse_of_one_place_by_hand(published):
    import statistics

    place, month = "Butte Creek", 3
    flows = published("flows_cfs").filter((F.col("scenario") == "LTO_12a") & (F.col("place") == place))
    values = [r["flow_cfs"] for r in flows.collect() if r["date"].month == month and 1980 <= r["date"].year <= 1999]
    want = statistics.stdev(values) / statistics.median(values) / 100
    cell = published("proportion_pulse_flows").filter(
        (F.col("scenario") == "LTO_12a") & (F.col("place") == place) & (F.col("month") == month)
    ).first()
    assert cell["value"] == pytest.approx(want)


def test_compat_slips_of_the_newer_run(runs):
    from freshet.functions.units import CMS_PER_CFS
    from freshet.plans import diversions

    flows = runs.of("LTO_12a")
    pick = lambda df, p: {(r["year"], r["month"]): r["value"] for r in df.filter(F.col("place") == p).collect()}
    literal = diversions.total_diverted(flows, "calsim3", compat=True)
    upper = pick(literal, maps.UPPER_SACRAMENTO)
    nodes = [t[3] for t in maps.diversion_terms("calsim3") if t[1] == maps.UPPER_SACRAMENTO and t[2] == "num"]
    total = flows.filter(F.col("node").isin(nodes)).agg(F.sum("flow_cfs")).first()[0]
    assert set(upper.values()) == {total * CMS_PER_CFS}
    documented = diversions.total_diverted(flows, "calsim3")
    assert len(set(pick(documented, maps.UPPER_SACRAMENTO).values())) > 1
    assert pick(literal, "Butte Creek") == pick(documented, "Butte Creek")
    yuba = pick(diversions.proportion_diverted(flows, "calsim3", compat=True), "Yuba River")
    # The node over itself twice is a half, times the unit factor; 0 over 0 is filled with 0.
    assert all(v == pytest.approx(CMS_PER_CFS / 2) for v in yuba.values() if v) and any(yuba.values())


def test_mokelumne_comes_from_the_separate_run(runs, published):
    from freshet.functions.units import CMS_PER_CFS

    cube = published("total_diverted").filter(F.col("place") == maps.MOKELUMNE)
    got = {(r["scenario"], r["year"], r["month"]): r["value"] for r in cube.filter("scenario = 'run_of_river'").collect()}
    east = runs.east_side.filter((F.col("scenario") == "run_of_river") & F.col("node").isin(maps.MOKELUMNE_DIVERSIONS))
    want = {}
    for r in east.collect():
        if 1980 <= r["date"].year <= 2000:
            key = ("run_of_river", r["date"].year, r["date"].month)
            want[key] = want.get(key, 0) + r["flow_cfs"]
    assert got == {k: pytest.approx(v * CMS_PER_CFS) for k, v in want.items()}


def test_built_and_read_back_agree(runs, published):
    columns = ["scenario", "place", "month", "year", "value"]
    built = catalogue.build(runs, "mean_flow").select(*columns)
    assert built.exceptAll(published("mean_flow").select(*columns)).count() == 0
