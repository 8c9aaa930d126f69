"""Reshaping, node lists, joins, overrides and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check
from freshet.functions.units import CMS_PER_CFS, cfs_to_cms
from freshet.operators import compare as C
from freshet.operators import lookup as L
from freshet.operators.reshape import (
    month_year_matrix,
    split_list,
    to_long,
    to_wide,
    union_rules,
    year_month_matrix,
)
from freshet.operators.skew import year_list
from freshet.operators.stats import place_summary
from freshet.plans.flows import candidate_nodes
from freshet.sources.exports import wide_export

KEYS = ["scenario", "date"]
FIRST, LAST = V.YEARS
YEARS = range(FIRST, LAST + 1)


def _unpivot(source: str, keys: str, value: str = "flow_cfs") -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{n}' AS node, {n} AS {value} FROM {source}" for n in V.NODES)


def _pick(names, column: str, value: str, prefix: str = "") -> str:
    def literal(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join(f'max(CASE WHEN {column} = {literal(n)} THEN {value} END) AS "{prefix}{n}"' for n in names)


@check(V.query(_unpivot("basin_wide", "scenario, basin, date"), V.BASIN_WIDE))
def unpivot_nodes(spark, sf):
    return to_long(V.basin_wide(spark, sf), ["scenario", "basin", "date"], V.NODES)


@check(V.query("SELECT scenario, date, " + ", ".join(V.NODES) + " FROM wide_nodes", V.WIDE_NODES))
def pivot_nodes(spark, sf):
    return to_wide(V.node_flow(spark, sf), KEYS, "node", "flow_cfs", V.NODES)


_CMS = f"flow_cfs * {CMS_PER_CFS!r}::DOUBLE"


@check(V.query(f"""SELECT scenario, place, CAST(month(date) AS INTEGER) AS month,
  {_pick(YEARS, 'year(date)', _CMS, 'y')} FROM place_flow GROUP BY 1, 2, 3""", V.PLACE_FLOW))
def flagship_matrix(spark, sf):
    flows = V.place_flow(spark, sf, V.YEARS).withColumn("flow_cms", cfs_to_cms("flow_cfs"))
    return month_year_matrix(flows, "flow_cms", YEARS, ["scenario", "place"])


_AT_LEAST_IN_WINDOW = f"year(date) BETWEEN {FIRST} AND {LAST}"
SQL_WINDOW = _AT_LEAST_IN_WINDOW


@check(V.query(f"""SELECT scenario, node, CAST(month(date) AS INTEGER) AS month,
  {_pick(YEARS, 'year(date)', 'flow_cfs', 'y')} FROM supplier_flow WHERE {SQL_WINDOW} GROUP BY 1, 2, 3""",
               V.SUPPLIER_FLOW), name="month_year_matrix")
def month_year_matrix_query(spark, sf):
    return month_year_matrix(V.supplier_flow(spark, sf, V.YEARS), "flow_cfs", YEARS, ["scenario", "node"])


@check(V.query(f"""SELECT scenario, node, CAST(year(date) AS INTEGER) AS year,
  {_pick(range(1, 13), 'month(date)', 'flow_cfs', 'm')} FROM supplier_flow WHERE {SQL_WINDOW} GROUP BY 1, 2, 3""",
               V.SUPPLIER_FLOW), name="year_month_matrix")
def year_month_matrix_query(spark, sf):
    return year_month_matrix(V.supplier_flow(spark, sf, V.YEARS), "flow_cfs", YEARS, ["scenario", "node"])


NODE_LISTS = [
    ("Upper", "N1"),
    ("Middle", "N2, N3 ,N4, "),
    ("Lower", "NA"),
    ("Shared", " N4,N5 "),
]


@check(V.query("""SELECT scenario, date, place, count(*) AS n_nodes, sum(flow_cfs) AS flow_cfs
FROM node_flow JOIN lists USING (node) GROUP BY 1, 2, 3""", V.NODE_FLOW,
               V.values_cte("lists", ["place", "node"], [
                   ("Upper", "N1"), ("Middle", "N2"), ("Middle", "N3"), ("Middle", "N4"), ("Shared", "N4"),
                   ("Shared", "N5")])))
def explode_node_list(spark, sf):
    lists = L.small_frame(spark, NODE_LISTS, "place string, nodes string")
    terms = F.broadcast(split_list(lists, "nodes", "node").drop("nodes"))
    return (
        L.map_nodes(V.node_flow(spark, sf), terms)
        .groupBy(*KEYS, "place")
        .agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("flow_cfs").alias("flow_cfs"))
    )


@check(V.query("""SELECT scenario, date, node, CASE WHEN node = 'N3' THEN other ELSE flow_cfs END AS flow_cfs
FROM node_flow LEFT JOIN (SELECT date, flow_cfs AS other FROM second_source
                          WHERE node = '1-URGENT' AND month(date) <> 4) s USING (date)""",
               V.NODE_FLOW, V.SECOND_SOURCE))
def left_join_override(spark, sf):
    source = V.second_source(spark, sf).filter((F.col("node") == "1-URGENT") & (F.month("date") != 4))
    return L.replace_series(V.node_flow(spark, sf), source, "N3", ["date"], key="node")


@check(V.query("""SELECT scenario, date, f.place, n_nationkey AS place_order, n_regionkey AS region, flow_cfs
FROM place_flow f JOIN nation ON f.place = n_name""", V.PLACE_FLOW))
def dimension_order(spark, sf):
    dim = V.table(spark, sf, "nation").select(
        F.col("n_name").alias("place"), F.col("n_nationkey").alias("place_order"), F.col("n_regionkey").alias("region")
    )
    return L.by_dimension(V.place_flow(spark, sf), dim).orderBy("scenario", "date", "place_order")


LABELS = {"N1": "Upper Reach", "N2": "Middle Reach", "N3": "Lower Reach"}


@check(V.query("""SELECT scenario, date, node, flow_cfs, CASE node WHEN 'N1' THEN 'Upper Reach'
  WHEN 'N2' THEN 'Middle Reach' WHEN 'N3' THEN 'Lower Reach' END AS label FROM node_flow""", V.NODE_FLOW),
       name="lookup_label")
def lookup_label_query(spark, sf):
    return L.lookup_label(V.node_flow(spark, sf), LABELS, "node", "label")


@check(V.query("SELECT scenario, date, place, flow_cfs FROM place_flow", V.PLACE_FLOW))
def node_to_input_sum(spark, sf):
    return V.place_flow(spark, sf)


@check("""SELECT coalesce(s_suppkey, c_custkey) AS node, s_nationkey AS place_x, c_nationkey AS place_y
FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""")
def node_map_crosswalk(spark, sf):
    older = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("place"))
    newer = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("place"))
    return L.full_merge(older, newer, ["node"])


@check(V.query("""SELECT coalesce(a.scenario, b.scenario) AS scenario, coalesce(a.date, b.date) AS date,
  coalesce(a.node, b.node) AS node, CASE WHEN a.node IS NULL THEN b.flow_cfs ELSE a.flow_cfs END AS flow_cfs
FROM (SELECT * FROM node_flow WHERE node <= 'N3' OR (node <= 'N5' AND flow_cfs >= 800)) a
FULL JOIN (SELECT scenario, date, node, flow_cfs + 1000 AS flow_cfs FROM node_flow WHERE node >= 'N4') b
  ON a.scenario = b.scenario AND a.date = b.date AND a.node = b.node""", V.NODE_FLOW))
def full_merge_by_date(spark, sf):
    """Two runs that share two nodes; the first has gaps there, which the second fills."""
    node, flow = F.col("node"), F.col("flow_cfs")
    first = (node <= "N3") | ((node <= "N5") & (flow >= 800))
    return L.merge_rules(V.node_flow(spark, sf), [(first, flow), (node >= "N4", flow + 1000)], [*KEYS, "node"])


@check(V.query("""SELECT scenario, date, node, flow_cfs FROM node_flow
WHERE month(date) <> 2 AND flow_cfs >= 700 AND flow_cfs <= 1000""", V.NODE_FLOW))
def ingest_wide_nodes(spark, sf):
    # The month is also aggregated, so that its text is parsed once per month and not per line item.
    cells = [F.max(F.when(F.col("node") == n, F.col("flow_cfs"))).alias(n) for n in V.NODES]
    wide = V.node_flow(spark, sf).groupBy(*KEYS).agg(F.max("date").alias("day"), *cells)
    text = [
        F.when(F.col(n) < 700, F.lit("")).when(F.col(n) > 1000, F.lit("n/a")).otherwise(F.col(n).cast("string")).alias(n)
        for n in V.NODES
    ]
    # February stands for the unit row of an export: its date does not parse.
    date = F.when(F.month("day") == 2, F.lit("CFS")).otherwise(F.date_format("day", "ddMMMyyyy"))
    return wide_export(wide.select("scenario", date.alias("date"), *text), "date", "ddMMMyyyy", ["scenario"])


@check(V.query("""SELECT t.cl_date, t.cs_date, s.node, s.flow_cfs
FROM (SELECT DISTINCT CAST(date_trunc('month', date) + INTERVAL 19 YEAR AS DATE) AS cl_date,
        CASE WHEN month(date) <> 6 THEN CAST(date_trunc('month', date) AS DATE) END AS cs_date FROM second_source) t
LEFT JOIN (SELECT * FROM second_source WHERE month(date) <> 3) s
  ON CAST(date_trunc('month', s.date) AS DATE) = t.cs_date""", V.SECOND_SOURCE), name="calendar_remap")
def calendar_remap_query(spark, sf):
    """June has no month to read, and the series lacks every March."""
    source = V.second_source(spark, sf)
    calendar = source.select(
        F.add_months(F.trunc("date", "month"), 19 * 12).alias("cl_date"),
        F.when(F.month("date") != 6, F.col("date")).alias("cs_date"),
    )
    return L.calendar_remap(source.filter(F.month("date") != 3), calendar.distinct())


@check(V.query("""SELECT scenario, date, node, flow_cfs, CASE WHEN scenario = 'N' THEN flow_cfs * 2 END AS doubled
FROM node_flow WHERE scenario IN ('A', 'N')""", V.NODE_FLOW))
def union_scenarios(spark, sf):
    a, n = (F.col("scenario") == s for s in ("A", "N"))
    return union_rules(V.node_flow(spark, sf), [(a, {}), (n, {"doubled": F.col("flow_cfs") * 2})])


@check("""WITH kept AS (SELECT l_partkey AS place, l_returnflag AS scenario FROM lineitem),
shared AS (SELECT place FROM kept WHERE scenario = 'A' INTERSECT SELECT place FROM kept WHERE scenario = 'N'
           INTERSECT SELECT place FROM kept WHERE scenario = 'R')
SELECT scenario, place, count(*) AS n FROM kept WHERE place IN (SELECT place FROM shared) GROUP BY 1, 2""",
       name="shared_watersheds")
def shared_watersheds(spark, sf):
    rows = V.shipped(spark, sf).groupBy("scenario", F.col("l_partkey").alias("place")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return C.shared_rows(rows, V.SCENARIOS)


@check("""SELECT l_partkey AS place FROM lineitem WHERE l_returnflag = 'A'
INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'""")
def shared_places(spark, sf):
    rows = V.shipped(spark, sf)
    return C.shared_places(rows.withColumnRenamed("l_partkey", "place"), ["A", "N"])


@check(V.query("""SELECT coalesce(a.date, b.date) AS date, coalesce(a.node, b.node) AS node,
  a.flow_cfs AS left_value, b.flow_cfs AS right_value, b.flow_cfs - a.flow_cfs AS difference
FROM (SELECT * FROM supplier_flow WHERE scenario = 'A') a
FULL JOIN (SELECT * FROM supplier_flow WHERE scenario = 'N') b ON a.date = b.date AND a.node = b.node""",
               V.SUPPLIER_FLOW))
def scenario_compare(spark, sf):
    return C.scenario_difference(V.supplier_flow(spark, sf), "A", "N", ["date", "node"], "flow_cfs")


@check(V.query("""SELECT date, node, 'A' AS only_in FROM (SELECT date, node FROM supplier_flow WHERE scenario = 'A'
  EXCEPT SELECT date, node FROM supplier_flow WHERE scenario = 'N')
UNION ALL SELECT date, node, 'N' FROM (SELECT date, node FROM supplier_flow WHERE scenario = 'N'
  EXCEPT SELECT date, node FROM supplier_flow WHERE scenario = 'A')""", V.SUPPLIER_FLOW), name="key_set_diff")
def key_set_diff_query(spark, sf):
    return C.key_set_diff(V.supplier_flow(spark, sf), "A", "N", ["date", "node"])


@check(V.query(" UNION ALL ".join(
    f"SELECT scenario, date, '{label}' AS node, {expr} AS flow_cfs FROM wide_nodes WHERE year(date) BETWEEN 1996 AND 1999 "
    f"AND coalesce({seen}) IS NOT NULL"
    for label, expr, seen in (("N1", "N1", "N1"), ("N4", "N4", "N4"), ("N2 + N3", "N2 + N3", "N2, N3"))
), V.WIDE_NODES), name="candidate_nodes")
def candidate_nodes_query(spark, sf):
    return candidate_nodes(V.node_flow(spark, sf, (1996, 1999)), ["N1", "N4"], [("N2", "N3")], 1996, 1999)


@check(V.query("""SELECT scenario, place, sum(flow_cfs) / count(flow_cfs) AS mean_flow, min(flow_cfs) AS min_flow,
  max(flow_cfs) AS max_flow FROM place_flow GROUP BY 1, 2""", V.PLACE_FLOW))
def watershed_summary(spark, sf):
    return place_summary(V.place_flow(spark, sf))


@check(V.query("""SELECT scenario, date, node, flow_cfs FROM node_flow
WHERE year(date) IN (SELECT year FROM year_types WHERE location = '1-URGENT'
                     AND year_type NOT IN ('Wet', 'Above Normal'))""", V.NODE_FLOW, V.YEAR_TYPES))
def dry_year_semi(spark, sf):
    from freshet.plans.functional import dry_years

    years = dry_years(V.year_types(spark, sf), V.LOCATION, 1995, 2001)
    flows = V.node_flow(spark, sf).withColumn("year", F.year("date"))
    return flows.join(year_list(years), "year", "left_semi").drop("year")


@check(V.query("""SELECT scenario, date, node, CASE WHEN is_dry THEN flow_cfs + 5000 ELSE flow_cfs END AS flow_cfs
FROM (SELECT 'N' AS scenario, date, node, flow_cfs, year(date) IN (SELECT year FROM year_types
        WHERE location = '1-URGENT' AND year_type NOT IN ('Wet', 'Above Normal')) AS is_dry, scenario AS s
      FROM supplier_flow) WHERE (is_dry AND s = 'A') OR (NOT is_dry AND s = 'N')""",
               V.SUPPLIER_FLOW, V.YEAR_TYPES), name="splice_by_year")
def splice_by_year_query(spark, sf):
    from freshet.plans.functional import dry_years

    flows = V.supplier_flow(spark, sf)
    inside = flows.filter(F.col("scenario") == "A").withColumn("flow_cfs", F.col("flow_cfs") + 5000)
    outside = flows.filter(F.col("scenario") == "N")
    years = dry_years(V.year_types(spark, sf), V.LOCATION, 1995, 2001)
    return L.splice_by_year(inside.withColumn("scenario", F.lit("N")), outside, years)
