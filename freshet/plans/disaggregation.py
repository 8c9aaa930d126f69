"""Regional totals split over streams, and the assembled record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.missing import clamp_nonneg, quotient
from freshet.operators.formula import marked, repeated_over
from freshet.operators.lookup import small_frame
from freshet.operators.single import refuse
from freshet.operators.stats import fit_line
from freshet.plans import maps

KEYS = ["scenario", "date"]


def regional_share(
    node_flow: DataFrame,
    streams: Sequence[Sequence[str]] = tuple(maps.REGION_STREAMS),
    clamp: Sequence[str] = ("Eastside",),
) -> DataFrame:
    """Split each region's total over its streams by their share of the members' sum.

    ``streams`` rows are ``(region, stream or "", node, weight)``: a member without
    a stream counts in the sum only, and the weight scales the member's own part
    but not the sum. The region code is also the node of the regional total.
    A window holds one region and month, so it is as long as the member list.
    Several rows of a node in a month are an error. Regions in ``clamp`` turn negative and NaN results into 0.
    """
    regions = sorted({r[0] for r in streams})
    size = {r: sum(1 for s in streams if s[0] == r) for r in regions}
    members = [(r, s or None, n, float(w), False, size[r]) for r, s, n, w in streams]
    members += [(r, None, r, 1.0, True, size[r]) for r in regions]
    dim = small_frame(
        node_flow.sparkSession, marked(members, 0),
        "region string, place string, node string, weight double, is_total boolean, n_members long, mark long",
    )
    month = Window.partitionBy(*KEYS, "region")
    own = F.when(~F.col("is_total"), F.col("flow_cfs"))
    total = F.when(F.count(own).over(month) == F.col("n_members"), F.sum(own).over(month))
    rows = (
        node_flow.join(dim, "node")
        .withColumn("denominator", refuse(repeated_over("mark", month), "node", total))
        .withColumn("regional", F.max(F.when(F.col("is_total"), F.col("flow_cfs"))).over(month))
        .filter(F.col("place").isNotNull())
    )
    value = quotient(F.col("flow_cfs") * F.col("weight"), "denominator") * F.col("regional")
    clamped = F.when(F.col("region").isin(list(clamp)), clamp_nonneg(value)).otherwise(value)
    return rows.select(*KEYS, "region", "place", clamped.alias("flow_cfs"))


def assemble(parts: Sequence[DataFrame], places: Sequence[str] = tuple(maps.PLACES)) -> DataFrame:
    """Stack place series, keep the known places and dated rows, and attach the order."""
    dim = small_frame(
        parts[0].sparkSession, [(i + 1, p) for i, p in enumerate(places)], "place_order int, place string"
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("date").isNotNull()).join(dim, "place")


def spill_fit(
    wide: DataFrame,
    spills: Sequence[str] = tuple(maps.SPILL_NODES),
    river: str = maps.SPILL_RIVER_NODE,
    threshold: float = maps.SPILL_THRESHOLD_CFS,
) -> DataFrame:
    """Line of the summed weir flow on the river flow, from the threshold on."""
    total: Column = F.col(spills[0])
    for s in spills[1:]:
        total = total + F.col(s)
    return fit_line(wide.filter(F.col(river) >= threshold), total, F.col(river))
