"""Dense cubes, rule tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check
from freshet.functions.units import CMS_PER_CFS, cfs_to_cms
from freshet.operators import cube as C
from freshet.operators.reshape import to_long
from freshet.plans import gates as G
from freshet.plans import maps

FIRST, LAST = V.YEARS
N_YEARS = LAST - FIRST + 1
# Ten places, one of them without any flow.
PLACES = [f"NATION_{i}" for i in range(9)] + ["Nowhere"]

_GRID = (
    "SELECT s.scenario, p.place_order, p.place, CAST(m.month AS INTEGER) AS month, CAST(y.year AS INTEGER) AS year "
    "FROM (VALUES ('A'), ('N'), ('R')) s(scenario), places p, range(1, 13) m(month), "
    f"range({FIRST}, {LAST + 1}) y(year)"
)
_PLACES = V.values_cte("places", ["place_order", "place"], [(i + 1, p) for i, p in enumerate(PLACES)])
_CUBE = f"""cube AS (SELECT g.scenario, g.place_order, g.place, g.month, g.year,
  flow_cfs * {CMS_PER_CFS!r}::DOUBLE AS value
FROM ({_GRID}) g LEFT JOIN place_flow f ON f.scenario = g.scenario AND f.place = g.place
  AND year(f.date) = g.year AND month(f.date) = g.month)"""


def _series(spark, sf):
    return V.place_flow(spark, sf, V.YEARS).withColumn("value", cfs_to_cms("flow_cfs"))


def _cube(spark, sf, fill=None):
    return C.model_cube(_series(spark, sf), PLACES, FIRST, LAST, fill)


@check(V.query("SELECT scenario, place_order, place, month, year, coalesce(value, 0) AS value FROM cube",
               V.PLACE_FLOW, _PLACES, _CUBE))
def model_cube(spark, sf):
    return _cube(spark, sf, 0.0)


@check(V.query("SELECT scenario, place_order, place, month, year, value FROM cube", V.PLACE_FLOW, _PLACES, _CUBE))
def model_cube_unfilled(spark, sf):
    return _cube(spark, sf)


@check(V.query(f"""SELECT g.scenario, g.place, CAST(g.month AS INTEGER) AS month, CAST(g.year AS INTEGER) AS year,
  coalesce(f.flow_cfs, 0) AS value
FROM (SELECT s.scenario, p.s_suppkey AS place, m.month, y.year FROM (VALUES ('A'), ('N'), ('R')) s(scenario), supplier p,
             range(1, 13) m(month), range({FIRST}, {LAST + 1}) y(year)) g
LEFT JOIN supplier_flow f ON f.scenario = g.scenario AND f.node = g.place
  AND year(f.date) = g.year AND month(f.date) = g.month""", V.SUPPLIER_FLOW))
def supplier_cube(spark, sf):
    """A cube whose places are a growing table."""
    flows = V.supplier_flow(spark, sf, V.YEARS, lots=True).withColumnRenamed("node", "place")
    places = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place"))
    return C.table_cube(flows, places, V.SCENARIOS, FIRST, LAST, 0.0, "flow_cfs")


@check(f"""SELECT s.scenario, n.s_suppkey AS place, CAST(m.month AS INTEGER) AS month, CAST(y.year AS INTEGER) AS year
FROM (SELECT DISTINCT l_returnflag AS scenario FROM lineitem) s, supplier n, range(1, 13) m(month),
     range({FIRST}, {LAST + 1}) y(year)""")
def dense_grid(spark, sf):
    places = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place"))
    return C.grid(places, V.SCENARIOS, FIRST, LAST)


@check(V.query("SELECT scenario, place, month, year, value FROM cube", V.PLACE_FLOW, _PLACES, _CUBE))
def cube_explode(spark, sf):
    return C.unnest(C.nest(_cube(spark, sf)))


@check(V.query(f"""SELECT scenario, count(*) AS n_cells, CAST(0 AS BIGINT) AS n_duplicated,
  CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
  CAST({len(PLACES) * 12 * N_YEARS} AS BIGINT) AS n_expected, true AS complete FROM cube GROUP BY 1""",
               V.PLACE_FLOW, _PLACES, _CUBE))
def cube_completeness(spark, sf):
    return C.completeness(_cube(spark, sf), len(PLACES), N_YEARS)


@check(V.query(f"""SELECT g.scenario, CAST(CASE g.place WHEN 'North' THEN 1 ELSE 2 END AS INTEGER) AS place_order, g.place,
  CAST(g.month AS INTEGER) AS month, CAST(g.year AS INTEGER) AS year,
  CASE g.place WHEN 'North' THEN N1 + N2 ELSE N3 END * {CMS_PER_CFS!r}::DOUBLE AS value
FROM (SELECT s.scenario, p.place, m.month, y.year FROM (VALUES ('A'), ('N'), ('R')) s(scenario),
             (VALUES ('North'), ('South')) p(place), range(1, 13) m(month), range({FIRST}, {LAST + 1}) y(year)) g
LEFT JOIN wide_nodes f ON f.scenario = g.scenario AND year(f.date) = g.year AND month(f.date) = g.month""",
               V.WIDE_NODES))
def two_place_cube(spark, sf):
    wide = V.wide_nodes(spark, sf, V.YEARS)
    planes = wide.select("scenario", "date", (F.col("N1") + F.col("N2")).alias("North"), F.col("N3").alias("South"))
    long = to_long(planes, ["scenario", "date"], ["North", "South"], "place", "value")
    return C.model_cube(long.withColumn("value", cfs_to_cms("value")), ["North", "South"], FIRST, LAST)


@check(V.query("""SELECT c.scenario, c.place_order, c.place, c.month, c.year,
  CASE WHEN c.place = 'NATION_3' THEN s.flow_cfs ELSE c.value END AS value
FROM cube c LEFT JOIN second_source s ON s.node = '2-HIGH' AND year(s.date) = c.year AND month(s.date) = c.month
  AND c.month <> 4""", V.PLACE_FLOW, V.SECOND_SOURCE, _PLACES, _CUBE), name="override_slice")
def override_slice_query(spark, sf):
    source = V.second_source(spark, sf).filter((F.col("node") == "2-HIGH") & (F.month("date") != 4))
    monthly = source.select(F.year("date").alias("year"), F.month("date").alias("month"), F.col("flow_cfs").alias("value"))
    return C.override_slice(_cube(spark, sf), monthly, "NATION_3", keys=())


@check(V.query("""SELECT scenario, place_order, place, month, year,
  CASE WHEN year IN (SELECT year FROM year_types WHERE location = '1-URGENT'
    AND year_type NOT IN ('Wet', 'Above Normal')) THEN -coalesce(value, 1) ELSE value END AS value FROM cube""",
               V.PLACE_FLOW, V.YEAR_TYPES, _PLACES, _CUBE))
def splice_cube_years(spark, sf):
    from freshet.plans.functional import dry_years

    cube = _cube(spark, sf)
    other = cube.withColumn("value", -F.coalesce("value", F.lit(1.0)))
    years = dry_years(V.year_types(spark, sf), V.LOCATION, 1995, 2001)
    return C.splice_years(cube, other, years)


_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
_RULES = V.values_cte("rules", ["month", "days", "n"], [
    (m + 1, d, _DAYS[m]) for m, d in enumerate(maps.GATE_DAYS_CLOSED)
])


@check(V.query("""SELECT scenario, CAST(month AS INTEGER) AS month, CAST(days AS DOUBLE) AS days_closed,
  CAST(days AS DOUBLE) / n AS prop_closed, flow_cfs * CAST(days AS DOUBLE) / n AS closed_flow
FROM (SELECT s.scenario, r.month, r.n, CASE WHEN s.scenario = 'R' THEN r.n
        WHEN s.scenario = 'N' AND r.month = 5 THEN 28 WHEN s.scenario = 'N' AND r.month = 6 THEN 8 ELSE r.days END AS days
      FROM rules r, (VALUES ('A'), ('N'), ('R')) s(scenario))
JOIN (SELECT scenario, month(date) AS month, sum(flow_cfs) AS flow_cfs FROM supplier_flow GROUP BY 1, 2)
  USING (scenario, month)""", V.SUPPLIER_FLOW, _RULES))
def gate_rule_matrix(spark, sf):
    """The three rule tables, applied to the monthly flow of three scenarios."""
    rules = G.rule_table(spark)
    parts = {"A": G.gate_rule_matrix(rules), "N": G.gate_rule_matrix(rules, maps.GATE_OVERRIDES), "R": G.always_closed(rules)}
    tagged = [f.withColumn("scenario", F.lit(s)) for s, f in parts.items()]
    monthly = V.supplier_flow(spark, sf).groupBy("scenario", F.month("date").alias("month")).agg(
        F.sum("flow_cfs").alias("flow_cfs")
    )
    table = F.broadcast(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]))
    out = monthly.join(table, ["scenario", "month"])
    # Multiplied before the division, as in the SQL, so both round alike.
    closed = F.col("flow_cfs") * F.col("days_closed") / (F.col("days_in"))
    from freshet.functions.dates import days_in_plain_month

    return out.withColumn("days_in", days_in_plain_month("month")).withColumn("closed_flow", closed).select(
        "scenario", "month", "days_closed", "prop_closed", "closed_flow"
    )
