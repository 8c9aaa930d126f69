"""Node formulas over small maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check, sql_finite, sql_kind, sql_policy, sql_quotient
from freshet.functions.missing import (
    BYPASS_CAPPED,
    BYPASS_OPEN,
    DELTA_NORTH,
    DELTA_SOUTH,
    DIVERTED_CAPPED,
    DIVERTED_UNCAPPED,
    finite,
    kind,
    ratio,
)
from freshet.functions.units import LOWER_MID_REACHES, CMS_PER_CFS, cfs_to_cms
from freshet.operators import formula as R
from freshet.operators.reshape import to_wide

KEYS = ["scenario", "basin", "date"]
MONTH = ["scenario", "date"]

# metric, place, role, node, weight
TERMS = [
    ("diverted", "Upper", "num", "N1", 1.0),
    ("diverted", "Upper", "den", "N2", 1.0),
    ("diverted", "Middle", "num", "N2", 1.0),
    ("diverted", "Middle", "num", "N3", 0.5),
    ("diverted", "Middle", "den", "N4", 1.0),
    ("diverted", "Middle", "den", "N2", 1.0),
    ("diverted", "Lower", "num", "N5", 1.0),
    ("diverted", "Lower", "den", "N5", 1.0),
    ("diverted", "Lower", "den", "N6", 1.0),
]
_PLACES = {"Upper": ("N1", "N2"), "Middle": ("(N2 + N3 * 0.5::DOUBLE)", "(N4 + N2)"), "Lower": ("N5", "(N5 + N6)")}
_TOUCHED = {"Upper": "N1 N2", "Middle": "N2 N3 N4", "Lower": "N5 N6"}

_LOW = "low AS (SELECT scenario, basin, date, " + ", ".join(
    f"CASE WHEN {n} > 20 THEN {n} - 20 WHEN {n} IS NOT NULL THEN 0 END AS {n}" for n in V.NODES
) + " FROM basin_wide)"
_SUMS = "sums AS (" + " UNION ALL ".join(
    f"SELECT scenario, basin, date, '{p}' AS place, {n} AS num, {d} AS den FROM low "
    f"WHERE coalesce({', '.join(_TOUCHED[p].split())}) IS NOT NULL"
    for p, (n, d) in _PLACES.items()
) + ")"


def _low(spark, sf):
    """Sparse flows per basin; 20 is taken off so that zeros occur."""
    low = F.when(F.col("l_flow") > 20, F.col("l_flow") - 20).otherwise(F.lit(0.0))
    sums = (
        V.dealt(spark, sf)
        .groupBy("scenario", F.col("l_suppkey").alias("basin"), "date", "l_linenumber")
        .agg(F.sum("l_quantity").alias("l_flow"))
    )
    return sums.select(*KEYS, F.concat(F.lit("N"), "l_linenumber").alias("node"), low.alias("flow_cfs"))


@check(V.query("SELECT scenario, basin, date, 'diverted' AS metric, place, num, den FROM sums",
               V.BASIN_WIDE, _LOW, _SUMS))
def formula_sum(spark, sf):
    return R.formula_sums(_low(spark, sf), R.formula_frame(spark, TERMS), ("num", "den"), KEYS)


@check(V.query("""SELECT scenario, basin, date, 'diverted' AS metric, place, sum(w * flow_cfs) AS num
FROM (SELECT scenario, basin, date, node, flow_cfs FROM (""" + " UNION ALL ".join(
    f"SELECT scenario, basin, date, '{n}' AS node, {n} AS flow_cfs FROM low" for n in V.NODES
) + """) WHERE flow_cfs IS NOT NULL) JOIN terms USING (node) GROUP BY 1, 2, 3, 5""", V.BASIN_WIDE, _LOW,
               V.values_cte("terms", ["place", "node", "w"], [(t[1], t[3], t[4]) for t in TERMS if t[2] == "num"])))
def formula_sum_present(spark, sf):
    terms = [t for t in TERMS if t[2] == "num"]
    return R.formula_sums(_low(spark, sf), R.formula_frame(spark, terms), ("num",), KEYS, strict=False)


_X = f"ratios AS (SELECT *, {sql_quotient('num', 'den')} AS x FROM sums)"


@check(V.query(f"""SELECT scenario, basin, date, place, {sql_finite('v')} AS value, {sql_kind('v')} AS kind
FROM (SELECT *, CASE WHEN place = 'Middle' THEN {sql_policy('x', DIVERTED_UNCAPPED)}
                ELSE {sql_policy('x', DIVERTED_CAPPED)} END AS v FROM ratios)""", V.BASIN_WIDE, _LOW, _SUMS, _X))
def formula_ratio(spark, sf):
    shares = R.formula_ratio(
        _low(spark, sf), R.formula_frame(spark, TERMS), DIVERTED_CAPPED, {"Middle": DIVERTED_UNCAPPED}, KEYS
    )
    return shares.select(*KEYS, "place", finite("value").alias("value"), kind("value").alias("kind"))


@check(V.query("""SELECT scenario, date, place, CASE WHEN n = wanted THEN num END AS num
FROM (SELECT scenario, date, place, sum(flow_cfs) AS num, count(*) AS n
      FROM supplier_flow JOIN node_places USING (node) GROUP BY 1, 2, 3)
JOIN (SELECT place, count(*) AS wanted FROM node_places GROUP BY 1) USING (place)""",
               V.SUPPLIER_FLOW, V.NODE_PLACES))
def formula_table(spark, sf):
    """A formula map that is itself a growing table."""
    terms = V.node_places(spark, sf).select(
        F.lit("flow").alias("metric"), "place", F.lit("num").alias("role"), "node", F.lit(1.0).alias("weight")
    )
    sums = R.formula_sums(V.supplier_flow(spark, sf), R.with_term_counts(terms))
    return sums.select(*MONTH, "place", "num")


_DELTA = [
    ("delta", "n_in", "num", "N1"), ("delta", "n_in", "num", "N2"), ("delta", "s_in", "num", "N3"),
    ("delta", "n_div", "num", "N4"), ("delta", "n_div", "num", "N5"), ("delta", "s_div", "num", "N6"),
    ("delta", "s_div", "num", "N7"),
]


@check(V.query(f"""SELECT scenario, basin, date, n_in, s_in, n_div, s_div, {sql_finite('n')} AS n_prop,
  {sql_kind('n')} AS n_kind, {sql_finite('s')} AS s_prop, {sql_kind('s')} AS s_kind
FROM (SELECT *, {sql_policy('nx', DELTA_NORTH)} AS n, {sql_policy('sx', DELTA_SOUTH)} AS s
  FROM (SELECT *, {sql_quotient('n_div', 'n_in')} AS nx, {sql_quotient('s_div', 's_in')} AS sx
    FROM (SELECT scenario, basin, date, N1 + N2 AS n_in, N3 AS s_in, N4 + N5 AS n_div, N6 + N7 AS s_div FROM low)))""",
               V.BASIN_WIDE, _LOW))
def delta_flows(spark, sf):
    sums = R.formula_sums(_low(spark, sf), R.formula_frame(spark, _DELTA), ("num",), KEYS)
    wide = to_wide(sums, KEYS, "place", "num", ["n_in", "s_in", "n_div", "s_div"])
    shares = wide.withColumn("n", ratio("n_div", "n_in", DELTA_NORTH)).withColumn("s", ratio("s_div", "s_in", DELTA_SOUTH))
    return shares.select(
        *KEYS, "n_in", "s_in", "n_div", "s_div", finite("n").alias("n_prop"), kind("n").alias("n_kind"),
        finite("s").alias("s_prop"), kind("s").alias("s_kind"),
    )


_BYPASS = [("bypass", "Sutter Bypass", "num", n) for n in ("N1", "N2")] + [
    ("bypass", "Sutter Bypass", "den", "N3"), ("bypass", "Yolo Bypass", "num", "N4"), ("bypass", "Yolo Bypass", "den", "N5"),
]


@check(V.query(f"""SELECT scenario, basin, date, place, {sql_finite('v')} AS value, {sql_kind('v')} AS kind
FROM (SELECT scenario, basin, date, place, CASE WHEN place = 'Yolo Bypass' THEN {sql_policy('x', BYPASS_CAPPED)} ELSE x END AS v
  FROM (SELECT scenario, basin, date, 'Sutter Bypass' AS place, {sql_quotient('(N1 + N2)', 'N3')} AS x FROM low
        WHERE coalesce(N1, N2, N3) IS NOT NULL
        UNION ALL SELECT scenario, basin, date, 'Yolo Bypass', {sql_quotient('N4', 'N5')} FROM low
        WHERE coalesce(N4, N5) IS NOT NULL))""", V.BASIN_WIDE, _LOW))
def bypass_ratio(spark, sf):
    shares = R.formula_ratio(
        _low(spark, sf), R.formula_frame(spark, _BYPASS), BYPASS_CAPPED, {"Sutter Bypass": BYPASS_OPEN}, KEYS
    )
    return shares.select(*KEYS, "place", finite("value").alias("value"), kind("value").alias("kind"))


@check(V.query("""SELECT scenario, basin, date, N1 + N2 AS flow, N1 + N2 >= 30 AS overtopped
FROM low WHERE coalesce(N1, N2) IS NOT NULL""", V.BASIN_WIDE, _LOW))
def overtopped(spark, sf):
    terms = [("over", "Sutter Bypass", "num", n) for n in ("N1", "N2")]
    sums = R.formula_sums(_low(spark, sf), R.formula_frame(spark, terms), ("num",), KEYS)
    return sums.select(*KEYS, F.col("num").alias("flow"), (F.col("num") >= 30).alias("overtopped"))


@check(V.query(f"""SELECT scenario, date, place, sum(flow_cfs) * {CMS_PER_CFS!r}::DOUBLE AS exports_cms
FROM (SELECT scenario, date, CASE WHEN node IN ('N1', 'N2') THEN 'cvp' ELSE 'swp' END AS place, flow_cfs
      FROM node_flow WHERE node IN ('N1', 'N2', 'N3', 'N4', 'N5')) GROUP BY 1, 2, 3""", V.NODE_FLOW))
def export_totals(spark, sf):
    terms = [("exports", "cvp" if n in ("N1", "N2") else "swp", "num", n) for n in V.NODES[:5]]
    sums = R.formula_sums(V.node_flow(spark, sf), R.formula_frame(spark, terms), strict=False)
    return sums.select(*MONTH, "place", cfs_to_cms("num").alias("exports_cms"))


@check(V.query("""SELECT scenario, date, place, flow_cfs FROM node_flow JOIN places USING (node)""", V.NODE_FLOW,
               V.values_cte("places", ["node", "place"], [("N1", "Bear"), ("N1", "Paynes"), ("N2", "Deer"), ("N4", "Mill")])))
def watershed_flows(spark, sf):
    from freshet.operators.lookup import map_nodes, small_frame

    pairs = [("N1", "Bear"), ("N1", "Paynes"), ("N2", "Deer"), ("N4", "Mill")]
    dim = small_frame(spark, pairs, "node string, place string")
    return map_nodes(V.node_flow(spark, sf), dim).select(*MONTH, "place", "flow_cfs")


@check(V.query(f"""SELECT scenario, date, 'lower_mid' AS region,
  {LOWER_MID_REACHES[0]!r}::DOUBLE * N1 + {LOWER_MID_REACHES[1]!r}::DOUBLE * N2 AS flow_cfs FROM wide_nodes
  WHERE coalesce(N1, N2) IS NOT NULL
UNION ALL SELECT scenario, date, 'upper', sum(flow_cfs) FROM node_flow WHERE node IN ('N3', 'N4', 'N5') GROUP BY 1, 2
UNION ALL SELECT scenario, date, 'east', sum(flow_cfs) FROM node_flow WHERE node IN ('N6', 'N7') GROUP BY 1, 2""",
               V.WIDE_NODES, V.NODE_FLOW))
def region_flows(spark, sf):
    a, b = LOWER_MID_REACHES
    terms = [("flow", "lower_mid", "num", "N1", a), ("flow", "lower_mid", "num", "N2", b)]
    mid = R.formula_sums(V.node_flow(spark, sf), R.formula_frame(spark, terms))
    rest = [("flow", "upper", "num", n) for n in ("N3", "N4", "N5")] + [("flow", "east", "num", n) for n in ("N6", "N7")]
    others = R.formula_sums(V.node_flow(spark, sf), R.formula_frame(spark, rest), strict=False)
    return mid.unionByName(others).select(*MONTH, F.col("place").alias("region"), F.col("num").alias("flow_cfs"))
