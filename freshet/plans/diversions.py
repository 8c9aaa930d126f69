"""Diversion totals and proportions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.dates import in_years
from freshet.functions.missing import (
    DIVERTED_CAP_FIRST,
    DIVERTED_CAPPED,
    DIVERTED_ROUNDED,
    DIVERTED_UNCAPPED,
    quotient,
    ratio,
    strict_sum,
)
from freshet.functions.units import cfs_to_cms
from freshet.operators.cube import model_cube, override_slice
from freshet.operators.formula import KEYS, apportion, formula_frame, formula_ratio, formula_sums
from freshet.operators.single import only
from freshet.operators.stats import grand_total
from freshet.plans import maps

CELL = [*KEYS, "place", "value"]


def shared_diversions(node_flow: DataFrame) -> DataFrame:
    return apportion(node_flow, [tuple(r) for r in maps.SHARED_2])


def east_side_diversion(
    east_side: DataFrame, first: int, last: int, over_flow: bool = False, scenario: str | None = None
) -> DataFrame:
    """Mokelumne diversion of the separate run per (year, month), or its share of the flow.

    Shares are summed like volumes and neither capped nor filled. ``scenario`` takes
    the run that is one scenario of a table. It is told apart in the aggregate and not
    by a filter, so that a table of which other scenarios are needed too is read once.
    """
    chosen = east_side.filter(in_years("date", first, last))
    here = F.lit(True) if scenario is None else F.col("scenario") == scenario
    # One missing node makes the sum missing; several rows of one node are an error.
    total = None
    for node in maps.MOKELUMNE_DIVERSIONS:
        part = only(F.col("flow_cfs"), here & (F.col("node") == node), "node")
        total = part if total is None else total + part
    flow = only(F.col("flow_cfs"), here & (F.col("node") == maps.MOKELUMNE_FLOW), "node")
    keys = _run_keys(east_side) if scenario is None else []
    dated = chosen.groupBy(*keys, "date").agg(total.alias("diverted"), flow.alias("flow"))
    value = quotient("diverted", "flow") if over_flow else cfs_to_cms("diverted")
    return dated.groupBy(*keys, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        strict_sum(value).alias("value")
    )


def _run_keys(df: DataFrame) -> list[str]:
    """A separate run may be shared by all scenarios or be one per scenario."""
    return ["scenario"] if "scenario" in df.columns else []


def with_east_side(cube: DataFrame, monthly: DataFrame) -> DataFrame:
    """Put the separate run's months into the Mokelumne slice of every scenario."""
    return override_slice(cube, monthly, maps.MOKELUMNE, _run_keys(monthly))


def total_diverted(
    node_flow: DataFrame,
    family: str,
    first: int = 1980,
    last: int = 2000,
    east_side: DataFrame | None = None,
    compat: bool = False,
    east_scenario: str | None = None,
) -> DataFrame:
    """Cube of diverted volume in cms; missing is 0.

    ``east_side`` is the separate run of the Mokelumne: for all scenarios, one for each,
    or the one scenario ``east_scenario`` of it for all.

    ``compat`` gives the newer family's Upper Sacramento the grand total of all
    months instead of each month's sum.
    """
    rows = node_flow.filter(in_years("date", first, last)) if not compat else node_flow
    terms = [t for t in maps.diversion_terms(family) if t[2] == "num"]
    sums = formula_sums(rows, formula_frame(node_flow.sparkSession, terms))
    series = sums.select(*KEYS, "place", F.col("num").alias("value"))
    if family == "calsim2":
        series = series.unionByName(shared_diversions(rows).select(*CELL))
    elif compat and family == "calsim3":
        series = _grand_total_upper(series)
    cube = model_cube(
        series.withColumn("value", cfs_to_cms("value")), maps.PLACES, first, last, fill=0.0
    )
    if east_side is not None:
        cube = with_east_side(cube, east_side_diversion(east_side, first, last, scenario=east_scenario))
    return cube


def _grand_total_upper(series: DataFrame) -> DataFrame:
    upper = F.col("place") == maps.UPPER_SACRAMENTO
    total = grand_total(series.filter(upper), [F.col("value")], "value")
    return series.filter(~upper).unionByName(total.select(*series.columns))


def proportion_diverted(
    node_flow: DataFrame,
    family: str,
    first: int = 1980,
    last: int = 2000,
    east_side: DataFrame | None = None,
    compat: bool = False,
    east_scenario: str | None = None,
) -> DataFrame:
    """Cube of diversion over flow, under the family's policy.

    ``compat`` reproduces three slips of the newer family: the Upper Sacramento
    grand total, the Yuba denominator and the unit factor on a proportion.
    """
    spark = node_flow.sparkSession
    rows = node_flow if compat else node_flow.filter(in_years("date", first, last))
    formulas = formula_frame(spark, maps.diversion_terms(family, compat))
    if family == "calsim2":
        plain = formula_ratio(rows, formulas, DIVERTED_ROUNDED)
        shared = shared_diversions(rows).withColumn("value", ratio("value", "own", DIVERTED_ROUNDED))
        series = plain.select(*CELL).unionByName(shared.select(*CELL))
    elif family == "action_5":
        series = formula_ratio(rows, formulas, DIVERTED_CAP_FIRST).select(*CELL)
    elif compat:
        sums = formula_sums(rows, formulas, ("num", "den"))
        upper = F.col("place") == maps.UPPER_SACRAMENTO
        total = grand_total(sums.filter(upper), [F.col("num")], "num").select(*sums.columns)
        sums = sums.filter(~upper).unionByName(total)
        uncapped = F.col("place").isin(list(maps.UNCAPPED_3))
        value = F.when(uncapped, ratio("num", "den", DIVERTED_UNCAPPED)).otherwise(
            ratio("num", "den", DIVERTED_CAPPED)
        )
        series = sums.withColumn("value", cfs_to_cms(value)).select(*CELL)
    else:
        special = {p: DIVERTED_UNCAPPED for p in maps.UNCAPPED_3}
        series = formula_ratio(rows, formulas, DIVERTED_CAPPED, special).select(*CELL)
    cube = model_cube(series, maps.PLACES, first, last, fill=0.0)
    if east_side is not None:
        cube = with_east_side(cube, east_side_diversion(east_side, first, last, True, east_scenario))
    return cube
