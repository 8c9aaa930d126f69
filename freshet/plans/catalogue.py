"""All published datasets of all scenarios from the model runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.missing import PULSE_FILL
from freshet.operators.lookup import splice_by_year
from freshet.plans import delta, diversions, flows, functional, gates, maps
from freshet.sources import editions
from freshet.steps import kept

OLDER_RUNS = ("biop_2008_2009", "biop_itp_2018_2019", "run_of_river")
BASE_OF_EFF = "biop_itp_2018_2019"
NEWER_RUN = "LTO_12a"
SPLICED = "LTO_12a_eff_dy"
TAGGED_RUN = "action_5"


@dataclass
class Runs:
    """Model output and the tables it is read with.

    ``node_flow(scenario, date, node, flow_cfs)`` holds the older runs and the
    newer one; ``east_side(scenario, date, node, flow_cfs)`` the separate model
    of the older ones; ``tagged(scenario, date, node, dataset, region, flow_cfs)``
    the tagged run; ``years(location, year, idx, year_type)`` the year types.
    ``places``, ``deltas`` and ``matrices`` may hold the published ``flows_cfs`` and
    ``delta_flows`` and all one-place matrices, which other datasets then read.
    """

    node_flow: DataFrame
    east_side: DataFrame
    tagged: DataFrame
    years: DataFrame
    first: int = 1980
    last: int = 2000
    tagged_first: int = 1979
    places: DataFrame | None = None
    deltas: DataFrame | None = None
    matrices: DataFrame | None = None

    def of(self, *scenarios: str) -> DataFrame:
        return self.node_flow.filter(F.col("scenario").isin(list(scenarios)))


def union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _scenario(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("scenario") == name)


def _dry(r: Runs) -> DataFrame:
    return functional.dry_years(r.years, "Sacramento Valley", 1921, 2002)


def _valley(r: Runs, location: str) -> DataFrame:
    return r.years.filter((F.col("location") == location) & F.col("year").between(1922, 2003))


def synthetic(r: Runs) -> tuple[DataFrame, DataFrame]:
    """The two functional-flow series."""
    return (
        functional.synthetic_flow(_valley(r, "Sacramento Valley"), "Sacramento"),
        functional.synthetic_flow(_valley(r, "San Joaquin Valley"), "San Joaquin"),
    )


def flows_cfs(r: Runs) -> DataFrame:
    if r.places is not None:
        return r.places
    older = flows.watershed_flows(r.of(*OLDER_RUNS), "calsim2", r.east_side)
    newer = flows.watershed_flows(r.of(NEWER_RUN), "calsim3")
    eff = flows.eff_flows(_scenario(older, BASE_OF_EFF), *synthetic(r))
    spliced = splice_by_year(eff, newer.select(*eff.columns), _dry(r)).withColumn("scenario", F.lit(SPLICED))
    return union(older, newer, eff, spliced, tagged_flows(r))


def tagged_flows(r: Runs) -> DataFrame:
    return flows.region_flows(r.tagged.filter(F.year("date").between(r.tagged_first, r.last)))


def bypass_flows(r: Runs) -> DataFrame:
    return union(
        flows.bypass_flows(r.of(*OLDER_RUNS), "calsim2"),
        flows.bypass_flows(r.of(NEWER_RUN), "calsim3"),
        flows.tagged_bypass_flows(r.tagged),
    )


def _diverted(r: Runs, build: Callable) -> DataFrame:
    tagged = r.tagged.filter(F.col("dataset") == "prop_diversion")
    tagged = tagged.select("scenario", "date", "node", "flow_cfs").distinct()
    return union(
        build(r.of(*OLDER_RUNS), "calsim2", r.first, r.last, r.east_side),
        build(r.of(NEWER_RUN), "calsim3", r.first, r.last),
        build(tagged, "action_5", r.tagged_first, r.last),
    )


def total_diverted(r: Runs) -> DataFrame:
    return _diverted(r, diversions.total_diverted)


def proportion_diverted(r: Runs) -> DataFrame:
    return _diverted(r, diversions.proportion_diverted)


def mean_flow(r: Runs) -> DataFrame:
    """The two functional-flow scenarios take the bypasses of the run they are built on."""
    bypass = union(
        flows.bypass_flows(r.of(*OLDER_RUNS), "calsim2"), flows.bypass_flows(r.of(NEWER_RUN), "calsim3")
    )
    borrowed = [
        _scenario(bypass, BASE_OF_EFF).withColumn("scenario", F.lit(s)) for s in ("eff", SPLICED)
    ]
    places = flows_cfs(r).filter(F.col("scenario") != TAGGED_RUN)
    return flows.mean_flow(places, union(bypass, *borrowed), r.first, r.last)


def node_matrices(r: Runs) -> DataFrame:
    """The one-place matrices of the untagged runs, ``dataset`` naming each."""
    return union(
        flows.node_matrices(r.of(*OLDER_RUNS), "calsim2", r.first, r.last),
        flows.node_matrices(r.of(NEWER_RUN), "calsim3", r.first, r.last),
    )


def node_matrix(r: Runs, dataset: str) -> DataFrame:
    if r.matrices is not None:
        parts = [r.matrices.filter(F.col("dataset") == dataset).drop("dataset")]
    else:
        parts = [
            flows.node_matrix(r.of(*OLDER_RUNS), dataset, "calsim2", r.first, r.last),
            flows.node_matrix(r.of(NEWER_RUN), dataset, "calsim3", r.first, r.last),
        ]
    if TAGGED_RUN in maps.AVAILABLE[dataset]:
        name = {"upper_sacramento_flows": "upsac_flow", "cvp_exports": "cvp_exports_realized",
                "swp_exports": "swp_exports_realized"}.get(dataset, dataset)
        parts.append(flows.tagged_matrix(r.tagged, name, r.tagged_first, r.last))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def upper_sacramento_flows(r: Runs) -> DataFrame:
    runs = node_matrix(r, "upper_sacramento_flows")
    series = synthetic(r)[0].select(
        F.lit("eff").alias("scenario"), "date", F.lit(maps.UPPER_SACRAMENTO).alias("place"),
        F.col("new_cfs").alias("flow_cfs"),
    )
    newer = r.of(NEWER_RUN).filter(F.col("node") == "C_SAC257").select(
        "scenario", "date", F.lit(maps.UPPER_SACRAMENTO).alias("place"), "flow_cfs"
    )
    spliced = splice_by_year(series, newer, _dry(r)).withColumn("scenario", F.lit(SPLICED))
    made = flows.place_matrix(series.unionByName(spliced), maps.UPPER_SACRAMENTO, r.first, r.last)
    return runs.unionByName(made, allowMissingColumns=True)


def san_joaquin_flows(r: Runs) -> DataFrame:
    series = synthetic(r)[1].select(
        F.lit("eff").alias("scenario"), "date", F.lit(maps.SAN_JOAQUIN).alias("place"),
        F.col("new_cfs").alias("flow_cfs"),
    )
    newer = flows.watershed_flows(r.of(NEWER_RUN), "calsim3").filter(F.col("place") == maps.SAN_JOAQUIN)
    spliced = splice_by_year(series, newer.select(*series.columns), _dry(r)).withColumn("scenario", F.lit(SPLICED))
    made = flows.place_matrix(series.unionByName(spliced), maps.SAN_JOAQUIN, r.first, r.last)
    tagged = flows.place_matrix(tagged_flows(r), maps.SAN_JOAQUIN, r.tagged_first, r.last)
    return made.unionByName(tagged, allowMissingColumns=True)


def proportion_flow_natal(r: Runs) -> DataFrame:
    runs = flows_cfs(r).filter(F.col("scenario") != SPLICED)
    return flows.proportion_flow_natal(runs, 1979, r.last)


def proportion_pulse_flows(r: Runs) -> DataFrame:
    """Each scenario keeps or fills its missing ratios by its own rule."""
    places = flows_cfs(r)
    special = list(flows.PULSE_POLICIES)
    window = (1980, 1999)
    parts = [
        flows.proportion_pulse_flows(_scenario(places, s), p, *window) for s, p in flows.PULSE_POLICIES.items()
    ]
    filled = places.filter(~F.col("scenario").isin([*special, TAGGED_RUN]))
    parts.append(flows.proportion_pulse_flows(filled, PULSE_FILL, *window))
    tagged = _scenario(places, TAGGED_RUN)
    parts.append(flows.proportion_pulse_flows(tagged, PULSE_FILL, *window, blend=False))
    return union(*parts)


def delta_flows(r: Runs) -> DataFrame:
    if r.deltas is not None:
        return r.deltas
    older = delta.delta_flows(r.of(*OLDER_RUNS), "calsim2")
    newer = delta.delta_flows(r.of(NEWER_RUN), "calsim3", r.of("run_of_river"))
    return union(older, newer, delta.tagged_delta_flows(r.tagged, r.tagged_first, r.last))


def _delta_cube(r: Runs, measure: str) -> DataFrame:
    series = delta_flows(r)
    runs = series.filter(F.col("scenario") != TAGGED_RUN)
    return union(
        delta.delta_cube(runs, measure, r.first, r.last),
        delta.delta_cube(_scenario(series, TAGGED_RUN), measure, r.tagged_first, r.last),
    )


def _bypass_cube(r: Runs, build: Callable) -> DataFrame:
    return union(
        build(r.of(*OLDER_RUNS), "calsim2", r.first, r.last),
        build(r.of(NEWER_RUN), "calsim3", r.first, r.last),
        build(r.tagged, "action_5", r.tagged_first, r.last),
    )


def _hatchery(r: Runs, months: tuple[int, int]) -> DataFrame:
    chosen = flows_cfs(r).filter(F.col("scenario").isin(BASE_OF_EFF, NEWER_RUN))
    return flows.hatchery_flows(chosen, months, 1980, 2002)


BUILDERS: dict[str, Callable[[Runs], DataFrame]] = {
    "flows_cfs": flows_cfs,
    "bypass_flows": bypass_flows,
    "total_diverted": total_diverted,
    "proportion_diverted": proportion_diverted,
    "mean_flow": mean_flow,
    "upper_sacramento_flows": upper_sacramento_flows,
    "san_joaquin_flows": san_joaquin_flows,
    "proportion_flow_natal": proportion_flow_natal,
    "proportion_pulse_flows": proportion_pulse_flows,
    "delta_cross_channel_closed": lambda r: gates.delta_cross_channel_closed(r.node_flow.sparkSession),
    "delta_flows": delta_flows,
    "delta_inflow": lambda r: _delta_cube(r, "inflow"),
    "delta_proportion_diverted": lambda r: _delta_cube(r, "prop_div"),
    "delta_total_diverted": lambda r: _delta_cube(r, "div"),
    "proportion_flow_bypasses": lambda r: _bypass_cube(r, delta.proportion_flow_bypasses),
    "gates_overtopped": lambda r: _bypass_cube(r, delta.gates_overtopped),
    **{
        name: (lambda r, name=name: node_matrix(r, name))
        for name in ("wilkins_flow", "freeport_flow", "vernalis_flow", "stockton_flow", "cvp_exports", "swp_exports")
    },
    "hatchery_oct_nov_flows": lambda r: _hatchery(r, (10, 11)),
    "hatchery_apr_may_flows": lambda r: _hatchery(r, (4, 5)),
}


def build(r: Runs, dataset: str) -> DataFrame:
    """One dataset, all its scenarios."""
    return BUILDERS[dataset](r)


def publish_all(r: Runs, root: str) -> None:
    """Write every dataset as one edition: readers see all of it or that before.

    What several datasets are built on is written first and read back: the flows,
    the delta flows, and all one-place matrices from one scan.
    """
    spark = r.node_flow.sparkSession
    with editions.draft(spark, root) as draft:
        for name in ("flows_cfs", "delta_flows"):
            draft.write(name, build(r, name))
        columns = ["scenario", "date", "place", "flow_cfs"]
        r = replace(
            r,
            places=draft.read("flows_cfs").select(*columns),
            deltas=draft.read("delta_flows"),
            matrices=kept(node_matrices(r)),
        )
        for name in BUILDERS:
            if name not in ("flows_cfs", "delta_flows"):
                draft.write(name, build(r, name))
