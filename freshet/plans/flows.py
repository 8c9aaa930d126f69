"""Flows by place, bypass flows, mean flow, matrices, natal and pulse proportions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.dates import in_years
from freshet.functions.missing import (
    NATAL,
    PULSE_FILL,
    PULSE_KEEP,
    PULSE_NAN_ZERO,
    RatioPolicy,
    ratio,
    strict_sum,
)
from freshet.functions.units import LOWER_MID_REACHES, cfs_to_cms, weighted_blend
from freshet.operators.cube import model_cube
from freshet.operators.formula import formula_frame, formula_sums
from freshet.operators.lookup import lookup_label, map_nodes, replace_series, small_frame
from freshet.operators.reshape import month_year_matrix, to_long, to_wide
from freshet.operators.single import only, refuse
from freshet.operators.skew import per_date
from freshet.operators.stats import monthly_median, pulse_ratio, seasonal_mean
from freshet.plans import maps

KEYS = ["scenario", "date"]
FLOW = [*KEYS, "place", "flow_cfs"]
FLOW_PLACES = [row[0] for row in maps.FLOW_NODES]


def watershed_flows(node_flow: DataFrame, family: str, east_side: DataFrame | None = None) -> DataFrame:
    """Flow per place: ``(scenario, date, place, flow_cfs)``.

    In the older family the Mokelumne comes from a separate run, ``east_side(date,
    node, flow_cfs)``, with a scenario column if runs have different ones; without
    it, or in months it lacks, the value is missing.
    """
    pairs = [(node, place, True) for node, place in maps.flow_map(family)]
    if family == "calsim2":
        # The first place's node carries the run's months for the place without a node.
        pairs.append((pairs[0][0], maps.MOKELUMNE, False))
    dim = small_frame(node_flow.sparkSession, pairs, "node string, place string, own boolean")
    flows = map_nodes(node_flow, dim).withColumn("flow_cfs", F.when(F.col("own"), F.col("flow_cfs"))).select(*FLOW)
    if family != "calsim2" or east_side is None:
        return flows
    keys = KEYS if "scenario" in east_side.columns else ["date"]
    moke = east_side.filter(F.col("node") == maps.MOKELUMNE_FLOW).select(*keys, "flow_cfs")
    return replace_series(flows, moke, maps.MOKELUMNE, keys)


def region_flows(tagged: DataFrame, dataset: str = "avg_flows") -> DataFrame:
    """Flow per place of a tagged run: region sums, the lower-mid reach blended.

    ``tagged(scenario, date, node, dataset, region, flow_cfs)``.
    """
    a, b = (row[2] for row in maps.FLOW_NODES if row[0] in maps.LOWER_MID)
    rows = tagged.filter(F.col("dataset") == dataset)
    pick = {n: only(F.col("flow_cfs"), F.col("node") == n, "node") for n in (a, b)}
    sums = rows.groupBy(*KEYS, "region").agg(
        strict_sum("flow_cfs").alias("total"), pick[a].alias("a"), pick[b].alias("b")
    )
    blended = F.col("region") == "lower_mid_sacramento_river"
    sums = sums.withColumn(
        "flow_cfs", F.when(blended, weighted_blend("a", "b", LOWER_MID_REACHES)).otherwise(F.col("total"))
    )
    return lookup_label(sums, maps.REGION_LABELS, "region", "place").select(*FLOW)


def change_upstream(
    wide: DataFrame,
    new_flow: DataFrame,
    place: str = maps.UPPER_SACRAMENTO,
    reaches: Sequence[str] = maps.DELTA_REACHES,
    floor: float = maps.FLOOR_CFS,
) -> DataFrame:
    """Put a new flow at one place of a wide frame and pass the change on downstream.

    ``new_flow(date, new_cfs)``. A place that would turn negative gets ``floor``;
    a missing value makes the place missing.
    """
    joined = wide.join(per_date(new_flow.select("date", "new_cfs")), "date", "left")
    change = F.col("new_cfs") - F.col(f"`{place}`")
    moved = {}
    for r in reaches:
        value = F.col(f"`{r}`") + change
        moved[r] = F.when(value < 0, F.lit(floor)).otherwise(value)
    moved[place] = F.col("new_cfs")
    return joined.withColumns(moved).select(*wide.columns)


def set_place(wide: DataFrame, new_flow: DataFrame, place: str = maps.SAN_JOAQUIN) -> DataFrame:
    """Replace one place's column of a wide frame; ``new_flow(date, new_cfs)``."""
    joined = wide.join(per_date(new_flow.select("date", "new_cfs")), "date", "left")
    return joined.withColumn(place, F.col("new_cfs")).select(*wide.columns)


def propagate_delta(
    flows: DataFrame,
    new_flow: DataFrame,
    place: str = maps.UPPER_SACRAMENTO,
    reaches: Sequence[str] = maps.DELTA_REACHES,
    floor: float = maps.FLOOR_CFS,
    places: Sequence[str] = tuple(FLOW_PLACES),
) -> DataFrame:
    """The same for a long frame: one shuffle brings a month's places together.

    Every place gets a row in every month the scenario has.
    """
    wide = to_wide(flows, KEYS, "place", "flow_cfs", places)
    return to_long(change_upstream(wide, new_flow, place, reaches, floor), KEYS, places, "place")


def eff_flows(flows: DataFrame, sacramento: DataFrame, san_joaquin: DataFrame) -> DataFrame:
    """The functional-flow scenario on top of a model run."""
    wide = to_wide(flows, KEYS, "place", "flow_cfs", FLOW_PLACES)
    changed = set_place(change_upstream(wide, sacramento), san_joaquin)
    return to_long(changed, KEYS, FLOW_PLACES, "place").withColumn("scenario", F.lit("eff"))


def alias_nodes(node_flow: DataFrame) -> DataFrame:
    """CalSim 3 nodes under the older codes; nodes of one code are summed as present."""
    pairs = [(n, code) for code, cell in maps.ALIASES for n in maps.nodes(cell)]
    dim = small_frame(node_flow.sparkSession, pairs, "node string, code string")
    return (
        node_flow.filter(F.col("flow_cfs").isNotNull())
        .join(dim, "node")
        .groupBy(*KEYS, "code")
        .agg(F.sum("flow_cfs").alias("flow_cfs"))
        .withColumnRenamed("code", "node")
    )


def bypass_flows(node_flow: DataFrame, family: str, accumulate: bool | None = None) -> DataFrame:
    """Flow per bypass segment: ``(scenario, date, place, flow_cfs)``.

    The older family is accumulated downstream and one missing node makes a
    segment missing; the newer one sums the nodes that are present, segment by
    segment. An accumulated segment is a formula over all nodes down to it.
    """
    older = family == "calsim2"
    c = 2 if older else 3
    terms, chain = [], {}
    for bypass, segment, *cells in maps.BYPASS_SEGMENTS:
        own = maps.nodes(cells[c - 2])
        if accumulate if accumulate is not None else older:
            own = chain[bypass] = chain.get(bypass, []) + own
        terms += [("bypass", segment, "num", n) for n in own]
    sums = formula_sums(node_flow, formula_frame(node_flow.sparkSession, terms), strict=older)
    return sums.select(*KEYS, "place", F.col("num").alias("flow_cfs"))


def tagged_bypass_flows(tagged: DataFrame) -> DataFrame:
    """The same for a tagged run: region sums, the first Sutter spills as one segment."""
    first = maps.nodes(maps.BYPASS_SEGMENTS[0][3])
    region = F.when(F.col("node").isin(first), F.lit("sutter1")).otherwise(F.col("region"))
    return (
        tagged.filter((F.col("dataset") == "bypass_flows") & in_years("date", 1979, 9998))
        .groupBy(*KEYS, region.alias("place"))
        .agg(strict_sum("flow_cfs").alias("flow_cfs"))
    )


def mean_flow(flows: DataFrame, bypass: DataFrame, first: int = 1980, last: int = 2000) -> DataFrame:
    """Cube of flows in cms; the last bypass segments stand for the bypasses.

    Missing values stay missing. ``bypass`` may belong to another scenario: its
    scenario column is what decides.
    """
    last_segment = lookup_label(
        bypass.select(*KEYS, F.col("place").alias("segment"), "flow_cfs"),
        maps.LAST_SEGMENTS, "segment", "place",
    )
    places = flows.filter(F.col("place") != maps.LOWER_MID[0]).withColumn(
        "place",
        F.when(F.col("place") == maps.LOWER_MID[1], "Lower-mid Sacramento River").otherwise(F.col("place")),
    )
    stacked = places.select(*FLOW).unionByName(last_segment.filter(F.col("place").isNotNull()).select(*FLOW))
    return model_cube(
        stacked.withColumn("value", cfs_to_cms("flow_cfs")), maps.PLACES, first, last, fill=None
    )


def misc_flows(node_flow_text: DataFrame) -> DataFrame:
    """Miscellaneous nodes as a wide frame; text values are cast, missing ones dropped."""
    rows = node_flow_text.filter(F.col("node").isin(maps.MISC_NODES)).withColumn(
        "flow_cfs", F.expr("try_cast(flow_cfs AS double)")
    )
    return to_wide(rows.filter(F.col("flow_cfs").isNotNull()), KEYS, "node", "flow_cfs", maps.MISC_NODES)


def node_matrices(
    node_flow: DataFrame,
    family: str,
    first: int = 1980,
    last: int = 2000,
    datasets: Sequence[str] = tuple(row[0] for row in maps.MATRIX_NODES),
) -> DataFrame:
    """Month x year matrices in cms of the one-place datasets, from one scan.

    A dataset of several nodes sums those that are present.
    """
    c = maps.column_of(family)
    terms = [
        ("matrix", row[0], "num", n) for row in maps.MATRIX_NODES if row[0] in datasets for n in maps.nodes(row[c])
    ]
    rows = node_flow.filter(in_years("date", first, last))
    sums = formula_sums(rows, formula_frame(node_flow.sparkSession, terms), strict=False)
    series = sums.select(*KEYS, F.col("place").alias("dataset"), cfs_to_cms("num").alias("flow_cms"))
    return month_year_matrix(series, "flow_cms", range(first, last + 1), ["scenario", "dataset"])


def node_matrix(
    node_flow: DataFrame, dataset: str, family: str, first: int = 1980, last: int = 2000
) -> DataFrame:
    """One of them."""
    return node_matrices(node_flow, family, first, last, [dataset]).drop("dataset")


def tagged_matrix(tagged: DataFrame, dataset: str, first: int = 1979, last: int = 2000) -> DataFrame:
    """The same for a tagged run, whose datasets are named in the rows."""
    series = tagged.filter((F.col("dataset") == dataset) & in_years("date", first, last))
    return month_year_matrix(
        series.withColumn("flow_cms", cfs_to_cms("flow_cfs")), "flow_cms", range(first, last + 1)
    )


def place_matrix(flows: DataFrame, place: str, first: int = 1980, last: int = 2000) -> DataFrame:
    """Month x year matrix in cms of one place."""
    series = flows.filter((F.col("place") == place) & in_years("date", first, last))
    return month_year_matrix(
        series.withColumn("flow_cms", cfs_to_cms("flow_cfs")), "flow_cms", range(first, last + 1)
    )


def freeport_series(node_flow: DataFrame) -> DataFrame:
    """Freeport flow in both units, missing months dropped."""
    return (
        node_flow.filter((F.col("node") == "C400") & F.col("flow_cfs").isNotNull())
        .select(*KEYS, F.col("flow_cfs").alias("freeportQcfs"))
        .withColumn("freeportQcms", cfs_to_cms("freeportQcfs"))
    )


def one_lower_mid(flows: DataFrame) -> DataFrame:
    """Keep the lower of the two lower-mid reaches under the common name."""
    kept = flows.filter(F.col("place") != maps.LOWER_MID[0])
    name = F.when(F.col("place") == maps.LOWER_MID[1], "Lower-mid Sacramento River").otherwise(F.col("place"))
    return kept.withColumn("place", name)


def blend_lower_mid(flows: DataFrame) -> DataFrame:
    """Replace the two lower-mid reaches by their length-weighted blend."""
    a, b = (only(F.col("flow_cfs"), F.col("place") == p, "place") for p in maps.LOWER_MID)
    reaches = flows.filter(F.col("place").isin(list(maps.LOWER_MID)))
    blended = reaches.groupBy(*KEYS).agg(a.alias("a"), b.alias("b"))
    blended = blended.withColumn("place", F.lit("Lower-mid Sacramento River")).withColumn(
        "flow_cfs", weighted_blend("a", "b")
    )
    rest = flows.filter(~F.col("place").isin(list(maps.LOWER_MID)))
    return rest.select(*FLOW).unionByName(blended.select(*FLOW))


def med_flow(flows: DataFrame, first: int = 1980, last: int = 2000) -> DataFrame:
    """Median flow per place and calendar month, the lower-mid reaches blended."""
    return monthly_median(blend_lower_mid(flows), first, last, complete=True)


def junction_ratio(
    flows: DataFrame,
    junctions: DataFrame,
    month: int = 10,
    fixed: Sequence[str] = maps.NATAL_FIXED,
    policy: RatioPolicy = NATAL,
    salts: int = 8,
) -> DataFrame:
    """One month's flow over the flow at the receiving junction.

    ``junctions(place, junction)``; places without a junction get the fill value. Several
    rows of one junction in a month are an error.

    Flows are read once: a row goes to its junction, and if it is one itself also to each
    of the ``salts`` parts into which the places of a junction are dealt, so a junction of
    many places is not one task. Places without a junction need no part in common.
    """
    chosen = flows.filter(F.month("date") == month)
    known = junctions.filter(F.col("place").isNotNull() & F.col("junction").isNotNull())
    ends = F.array(
        F.struct("place", F.col("junction").alias("to"), F.lit(False).alias("hub")),
        F.struct(F.col("junction").alias("place"), F.lit(None).alias("to"), F.lit(True).alias("hub")),
    )
    ends = known.select(F.explode(ends).alias("e")).select("e.*")
    links = ends.groupBy("place").agg(F.collect_list("to").alias("__to"), F.max("hub").alias("__hub"))
    linked = chosen.join(links, "place", "left")

    def entry(at: Column, salt: Column, hub: bool) -> Column:
        return F.struct(at.cast(place_type).alias("at"), salt.cast("long").alias("salt"), F.lit(hub).alias("hub"))

    place_type = flows.schema["place"].dataType
    lone = F.array(entry(F.lit(None), F.xxhash64("place"), False))
    own = F.transform("__to", lambda to: entry(to, F.pmod(F.xxhash64("place"), F.lit(salts)), False))
    own = F.when(F.size("__to") > 0, own).otherwise(lone)
    spread = F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: entry(F.col("place"), i, True))
    entries = F.when(F.col("__hub"), F.concat(own, spread)).otherwise(own)
    rows = linked.select(*KEYS, "place", "flow_cfs", F.explode(entries).alias("e")).select(*KEYS, "place", "flow_cfs", "e.*")
    part = Window.partitionBy(*KEYS, "at", "salt")
    hub_flow = F.max(F.when(F.col("hub"), F.col("flow_cfs"))).over(part)
    repeated = F.count(F.when(F.col("hub"), 1)).over(part) > 1
    rows = rows.withColumn("junction_flow", refuse(repeated, "junction", hub_flow)).filter(~F.col("hub"))
    value = F.when(F.col("place").isin(list(fixed)), F.lit(1.0)).otherwise(
        ratio("flow_cfs", "junction_flow", policy)
    )
    return rows.select(*KEYS, "place", F.year("date").alias("year"), value.alias("value"))


def proportion_flow_natal(flows: DataFrame, first: int = 1979, last: int = 2000) -> DataFrame:
    """October share of the natal river at its junction, ``(scenario, place, year, value)``.

    The places are a literal list, so a month's flows fit in one small map in
    which each place finds its own flow and its junction's: the flows are read once.
    """
    listed = list(set(maps.JUNCTIONS) | set(maps.JUNCTIONS.values()))
    chosen = one_lower_mid(flows).filter(
        in_years("date", first, last) & (F.month("date") == 10) & F.col("place").isin(listed)
    )
    entries = F.collect_list(F.struct("place", "flow_cfs"))
    months = chosen.groupBy(*KEYS).agg(F.map_from_entries(entries).alias("flows"))
    pairs = ", ".join(f"'{p}', '{j}'" for p, j in maps.JUNCTIONS.items())
    rows = months.select(*KEYS, "flows", F.expr(f"explode(map({pairs}))").alias("place", "junction"))
    found = [F.try_element_at("flows", F.col(c)) for c in ("place", "junction")]
    shares = rows.select(*KEYS, "place", ratio(*found, NATAL).alias("value"))
    october = model_cube(shares, maps.PLACES, first, last, fill=0.0).filter(F.col("month") == 10)
    # The fixed rivers count as 1 whether or not their flow is known.
    fixed = F.col("place").isin(list(maps.NATAL_FIXED))
    return october.withColumn("value", F.when(fixed, F.lit(1.0)).otherwise(F.col("value"))).drop("month")


PULSE_POLICIES = {
    "biop_2008_2009": PULSE_KEEP,
    "biop_itp_2018_2019": PULSE_KEEP,
    "run_of_river": PULSE_NAN_ZERO,
}


def proportion_pulse_flows(
    flows: DataFrame, policy: RatioPolicy = PULSE_FILL, first: int = 1980, last: int = 1999, blend: bool = True
) -> DataFrame:
    """Spread of the flow over its median, per place and calendar month; bypasses are 0.

    A place and month without a value in every year has no ratio.
    """
    source = blend_lower_mid(flows) if blend else flows
    stats = pulse_ratio(source, first, last, policy, complete=True)
    # The matrix is completed like a cube of one year.
    dated = stats.withColumn("date", F.make_date(F.lit(first), F.col("month"), F.lit(1)))
    cells = model_cube(dated.select("scenario", "place", "date", "value"), maps.PLACES, first, first)
    bypass = F.col("place").isin(list(maps.BYPASSES))
    value = F.when(bypass, F.lit(0.0)).otherwise(
        F.coalesce("value", F.lit(policy.on_null)) if policy.on_null is not None else F.col("value")
    )
    return cells.withColumn("value", value).drop("year")


def hatchery_flows(flows: DataFrame, months: Sequence[int], first: int = 1980, last: int = 2002) -> DataFrame:
    """Mean flow of two months per hatchery river, one column per year."""
    rivers = flows.filter(F.col("place").isin(maps.HATCHERY_PLACES))
    means = seasonal_mean(rivers, months, first, last, complete=True)
    return to_wide(means, ["scenario", "place"], "year", "value", range(first, last + 1), "y")


def climate_delta(node_flow: DataFrame) -> DataFrame:
    """North and south delta flow of the climate run."""
    terms = [("delta", p, "num", n) for p, cell in maps.CLIMATE_DELTA for n in maps.nodes(cell)]
    sums = formula_sums(node_flow, formula_frame(node_flow.sparkSession, terms))
    return sums.select(*KEYS, "place", F.col("num").alias("flow_cfs"))


def candidate_nodes(
    node_flow: DataFrame,
    nodes: Sequence[str] = tuple(maps.CANDIDATE_NODES),
    combined: Sequence[Sequence[str]] = (("D160", "D166A"),),
    first: int = 1980,
    last: int = 1999,
) -> DataFrame:
    """Candidate nodes side by side with sums of several, ``(scenario, date, node, flow_cfs)``."""
    terms = [("candidate", n, "num", n) for n in nodes]
    terms += [("candidate", " + ".join(group), "num", n) for group in combined for n in group]
    rows = node_flow.filter(in_years("date", first, last))
    sums = formula_sums(rows, formula_frame(node_flow.sparkSession, terms))
    return sums.select(*KEYS, F.col("place").alias("node"), F.col("num").alias("flow_cfs"))
