"""Delta flows, bypass proportions and overtopping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.dates import in_years
from freshet.functions.missing import BYPASS_CAPPED, BYPASS_OPEN, DELTA_NORTH, DELTA_SOUTH, ratio
from freshet.functions.units import cfs_to_cms
from freshet.operators.cube import model_cube
from freshet.operators.formula import KEYS, formula_frame, formula_ratio, formula_sums
from freshet.operators.lookup import clip_to_range
from freshet.operators.reshape import to_long, to_wide
from freshet.plans import maps
from freshet.plans.flows import alias_nodes

MEASURES = [row[0] for row in maps.DELTA_NODES]
PLANES = ["North Delta", "South Delta"]


def _proportions(wide: DataFrame, south=DELTA_SOUTH) -> DataFrame:
    return wide.withColumn(
        "n_dlt_prop_div", ratio("n_dlt_div_cfs", "n_dlt_inflow_cfs", DELTA_NORTH)
    ).withColumn("s_dlt_prop_div", ratio("s_dlt_div_cfs", "s_dlt_inflow_cfs", south))


def delta_flows(node_flow: DataFrame, family: str, clip_to: DataFrame | None = None) -> DataFrame:
    """Inflow, diversion and proportion of both delta halves, one row per month.

    The four sums come from one scan. In the older family one missing node makes
    a sum missing; in the newer one the nodes that are present count. ``clip_to``
    restricts the months to those another frame spans.
    """
    terms = maps.set_terms(maps.DELTA_NODES, "delta", family)
    sums = formula_sums(
        node_flow, formula_frame(node_flow.sparkSession, terms), strict=family == "calsim2"
    )
    wide = _proportions(to_wide(sums, KEYS, "place", "num", MEASURES))
    return wide if clip_to is None else clip_to_range(wide, clip_to)


def tagged_delta_flows(tagged: DataFrame, first: int = 1979, last: int = 2000) -> DataFrame:
    """The same for a tagged run, by region; the south keeps NaN for 0 over 0."""
    rows = tagged.filter(
        F.col("dataset").isin("delta_inflows", "delta_diversions_total") & in_years("date", first, last)
    )
    measure = F.concat(
        F.substring("region", 1, 1),
        F.when(F.col("dataset") == "delta_inflows", "_dlt_inflow_cfs").otherwise("_dlt_div_cfs"),
    )
    cells = [
        F.when(
            F.count(F.when(F.col("measure") == m, 1)) == F.count(F.when(F.col("measure") == m, F.col("flow_cfs"))),
            F.sum(F.when(F.col("measure") == m, F.col("flow_cfs"))),
        ).alias(m)
        for m in MEASURES
    ]
    return _proportions(rows.withColumn("measure", measure).groupBy(*KEYS).agg(*cells), BYPASS_CAPPED)


def delta_cube(
    flows: DataFrame, measure: str, first: int = 1980, last: int = 2000
) -> DataFrame:
    """Two-plane cube of ``inflow`` or ``div`` (in cms) or ``prop_div`` (as it is)."""
    suffix = "prop_div" if measure == "prop_div" else f"{measure}_cfs"
    north, south = f"n_dlt_{suffix}", f"s_dlt_{suffix}"
    long = to_long(flows.select(*KEYS, north, south), KEYS, [north, south], "measure", "value")
    place = F.when(F.col("measure") == north, PLANES[0]).otherwise(PLANES[1])
    value = F.col("value") if measure == "prop_div" else cfs_to_cms("value")
    return model_cube(long.withColumn("place", place).withColumn("value", value), PLANES, first, last)


def delta_inflow(flows: DataFrame, first: int = 1980, last: int = 2000) -> DataFrame:
    return delta_cube(flows, "inflow", first, last)


def delta_total_diverted(flows: DataFrame, first: int = 1980, last: int = 2000) -> DataFrame:
    return delta_cube(flows, "div", first, last)


def delta_proportion_diverted(flows: DataFrame, first: int = 1980, last: int = 2000) -> DataFrame:
    return delta_cube(flows, "prop_div", first, last)


def _unique(node_flow: DataFrame) -> DataFrame:
    """A tagged run repeats a node under several datasets; its rows are made distinct."""
    return node_flow.select(*KEYS, "node", "flow_cfs").distinct()


def proportion_flow_bypasses(
    node_flow: DataFrame, family: str, first: int = 1980, last: int = 2000
) -> DataFrame:
    """Share of the river entering each bypass.

    Only Yolo is capped, except in the tagged run, where both are.
    """
    rows = node_flow.filter(in_years("date", first, last))
    if family == "action_5":
        rows, terms, special = _unique(rows), maps.bypass_ratio_terms("action_5"), {}
    else:
        rows = alias_nodes(rows) if family == "calsim3" else rows
        terms, special = maps.bypass_ratio_terms("calsim2"), {"Sutter Bypass": BYPASS_OPEN}
    shares = formula_ratio(rows, formula_frame(node_flow.sparkSession, terms), BYPASS_CAPPED, special)
    return model_cube(shares, list(maps.BYPASSES), first, last)


def gates_overtopped(
    node_flow: DataFrame,
    family: str,
    first: int = 1980,
    last: int = 2000,
    threshold: float = maps.OVERTOPPED_CFS,
) -> DataFrame:
    """Whether a bypass carries at least the threshold, as a boolean cube."""
    return model_cube(overtopped_series(node_flow, family, first, last, threshold), list(maps.BYPASSES), first, last)


def overtopped_series(
    node_flow: DataFrame,
    family: str,
    first: int = 1979,
    last: int = 1999,
    threshold: float = maps.OVERTOPPED_CFS,
) -> DataFrame:
    """The flags as a series ``(scenario, date, place, value)``."""
    rows = node_flow.filter(in_years("date", first, last))
    c = 2 if family == "action_5" else 1
    if family == "action_5":
        rows = _unique(rows)
    elif family == "calsim3":
        rows = alias_nodes(rows)
    terms = [("over", r[0], "num", n) for r in maps.OVERTOPPED_NODES for n in maps.nodes(r[c])]
    sums = formula_sums(rows, formula_frame(node_flow.sparkSession, terms))
    return sums.select(*KEYS, "place", (F.col("num") >= threshold).alias("value"))
