"""Grouped statistics, regressions and the functional-flow chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check, sql_finite, sql_kind, sql_policy, sql_quotient
from freshet.functions.missing import PULSE_KEEP, finite, kind
from freshet.functions.units import ACRE_FEET_PER_MONTH_PER_CFS
from freshet.operators import stats as S
from freshet.operators.order_stats import exact_median
from freshet.plans import functional as P
from freshet.plans import maps
from freshet.plans.flows import junction_ratio, propagate_delta

KEYS = ["scenario", "date"]
FIRST, LAST = V.YEARS
IN_WINDOW = f"year(date) BETWEEN {FIRST} AND {LAST}"


@check(V.query("""SELECT place, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  sum(flow_cfs) AS flow_cfs FROM place_flow GROUP BY 1, 2, 3""", V.PLACE_FLOW))
def monthly_sum(spark, sf):
    return S.monthly_sum(V.place_flow(spark, sf), ["place"])


@check(V.query(f"""SELECT scenario, node AS place, CAST(year(date) AS INTEGER) AS year, sum(flow_cfs) / count(*) AS value
FROM supplier_flow WHERE {IN_WINDOW} AND month(date) IN (10, 11) GROUP BY 1, 2, 3""", V.SUPPLIER_FLOW))
def seasonal_mean(spark, sf):
    flows = V.supplier_flow(spark, sf, V.YEARS).withColumnRenamed("node", "place")
    return S.seasonal_mean(flows, (10, 11), FIRST, LAST)


@check(V.query(f"""SELECT scenario, node AS place, CAST(month(date) AS INTEGER) AS month, median(flow_cfs) AS value
FROM supplier_flow WHERE {IN_WINDOW} GROUP BY 1, 2, 3""", V.SUPPLIER_FLOW))
def monthly_median(spark, sf):
    flows = V.supplier_flow(spark, sf, V.YEARS).withColumnRenamed("node", "place")
    return S.monthly_median(flows, FIRST, LAST)


@check(V.query(f"""SELECT scenario, place, month, round({sql_finite('p')}, 6) AS value, {sql_kind('p')} AS kind
FROM (SELECT scenario, place, month, {sql_policy('x', PULSE_KEEP)} AS p
  FROM (SELECT scenario, place, month, {sql_quotient('(sd / 100)', 'median')} AS x
    FROM (SELECT scenario, node AS place, CAST(month(date) AS INTEGER) AS month, stddev_samp(flow) AS sd,
                 median(flow) AS median
          FROM (SELECT scenario, node, date, CASE WHEN flow_cfs > 30 THEN flow_cfs - 30 ELSE 0 END AS flow
                FROM supplier_flow WHERE {IN_WINDOW}) GROUP BY 1, 2, 3)))""", V.SUPPLIER_FLOW))
def pulse_ratio(spark, sf):
    low = F.when(F.col("flow_cfs") > 30, F.col("flow_cfs") - 30).otherwise(F.lit(0.0))
    flows = V.supplier_flow(spark, sf, V.YEARS).withColumnRenamed("node", "place").withColumn("flow_cfs", low)
    stats = S.pulse_ratio(flows, FIRST, LAST)
    return stats.select("scenario", "place", "month", F.round(finite("value"), 6).alias("value"), kind("value").alias("kind"))


@check(V.query("""SELECT gauge, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(date_trunc('month', min(date)) AS DATE) AS date, round(avg(flow), 6) AS monthly_mean_flow
FROM daily_gauge GROUP BY 1, 2, 3""", V.DAILY_GAUGE))
def daily_to_monthly_mean(spark, sf):
    means = S.daily_to_monthly_mean(V.daily_gauge(spark, sf), ["gauge"], "flow")
    return means.withColumn("monthly_mean_flow", F.round("monthly_mean_flow", 6))


@check(V.query("""SELECT CAST(date_trunc('month', min(date)) AS DATE) AS date, round(avg(flow), 9) AS flow, 'gauge' AS type
FROM daily_gauge WHERE year(date) BETWEEN 1992 AND 2012 GROUP BY year(date), month(date)
UNION ALL SELECT CAST(date_trunc('month', date) AS DATE), CAST(flow_cfs AS DOUBLE), 'model' FROM node_flow
WHERE year(date) BETWEEN 1992 AND 2012""", V.DAILY_GAUGE, V.NODE_FLOW))
def gauge_against_model(spark, sf):
    """All gauges together against all nodes of the runs."""
    model = V.node_flow(spark, sf).withColumnRenamed("flow_cfs", "flow")
    rows = S.gauge_against_model(V.daily_gauge(spark, sf), model, 1992, 2012, "flow")
    return rows.withColumn("flow", F.when(F.col("type") == "gauge", F.round("flow", 9)).otherwise(F.col("flow")))


@check(V.query(f"""SELECT scenario, node, CAST(year(date) AS INTEGER) AS year, round(v, 4) AS acre_feet,
  format('{{:,}}', CAST(round_even(v, 0) AS BIGINT)) AS acre_feet_text
FROM (SELECT scenario, node, year(date) AS year, sum(flow_cfs) * {ACRE_FEET_PER_MONTH_PER_CFS!r}::DOUBLE AS v,
             min(date) AS date FROM node_flow GROUP BY 1, 2, 3)""", V.NODE_FLOW))
def annual_volume(spark, sf):
    flows = V.node_flow(spark, sf).withColumn("year", F.year("date"))
    return S.annual_volume(flows, ["scenario", "node", "year"]).withColumn("acre_feet", F.round("acre_feet", 4))


@check(V.query("""SELECT scenario, date, N1 + N2 AS row_total,
  (SELECT CASE WHEN count(*) = count(N1 + N2) THEN sum(N1 + N2) END FROM wide_nodes) AS grand_total FROM wide_nodes""",
               V.WIDE_NODES))
def grand_total_compat(spark, sf):
    wide = V.wide_nodes(spark, sf)
    total = S.grand_total(wide, [F.col("N1"), F.col("N2")])
    return total.select(*KEYS, (F.col("N1") + F.col("N2")).alias("row_total"), "grand_total")


_FIT = """SELECT {key} round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept,
  round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n
FROM (SELECT l_returnflag AS scenario, l_extendedprice AS y, l_quantity AS x FROM lineitem WHERE l_quantity >= 15)
{group}"""


def _rounded_fit(fit):
    return (
        fit.withColumn("slope", F.round("slope", 4))
        .withColumn("intercept", F.round("intercept", 2))
        .withColumn("r2", F.round("r2", 6))
    )


@check(_FIT.format(key="scenario,", group="GROUP BY scenario"))
def regression_fit(spark, sf):
    rows = V.shipped(spark, sf).filter(F.col("l_quantity") >= 15)
    return _rounded_fit(S.fit_line(rows, F.col("l_extendedprice"), F.col("l_quantity"), ["scenario"]))


@check("""WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
  regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem WHERE l_quantity >= 15)
SELECT scenario, x, n, round(CASE WHEN x >= 15 THEN slope * x + intercept ELSE 0 END, 2) AS predicted
FROM (SELECT l_returnflag AS scenario, l_quantity AS x, count(*) AS n FROM lineitem GROUP BY 1, 2), fit""")
def regression_predict(spark, sf):
    rows = V.shipped(spark, sf)
    fit = S.fit_line(rows.filter(F.col("l_quantity") >= 15), F.col("l_extendedprice"), F.col("l_quantity"))
    levels = rows.groupBy("scenario", F.col("l_quantity").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    predicted = S.predict_line(levels, fit, F.col("x"), 15.0)
    return predicted.withColumn("predicted", F.round("predicted", 2))


@check(V.query("""SELECT location, year, idx, year_type, median_idx, abs(idx - median_idx) AS distance
FROM year_types JOIN (SELECT location, median(idx) AS median_idx FROM year_types
                      WHERE year_type IN ('Wet', 'Above Normal') GROUP BY 1) USING (location)
WHERE abs(idx - median_idx) < 1""", V.YEAR_TYPES))
def representative_years(spark, sf):
    return S.nearest_to_median(V.year_types(spark, sf), maps.WET_TYPES)


_TEMPLATE = V.values_cte("template", ["year_type", "month", "flow_cfs"], [
    (r[1], m + 1, float(v))
    for r in maps.TEMPLATES if r[0] == "Sacramento" and r[2] == "proposed"
    for m, v in enumerate(maps.nodes(r[3]))
])
_SYNTHETIC = """synthetic AS (
  SELECT location, year, year_type, month, CAST(flow_cfs AS DOUBLE) AS flow_cfs,
         last_day(make_date(CAST(year AS BIGINT), CAST(month AS BIGINT), 1)) AS date
  FROM (SELECT location, year, CASE WHEN year_type IN ('Wet', 'Above Normal') THEN 'Wet' ELSE 'Dry' END AS year_type
        FROM year_types) JOIN template USING (year_type))"""


@check(V.query("SELECT location, year, year_type, CAST(month AS INTEGER) AS month, flow_cfs, date FROM synthetic",
               V.YEAR_TYPES, _TEMPLATE, _SYNTHETIC))
def synthetic_series(spark, sf):
    years = P.classified_years(V.year_types(spark, sf)).select("location", "year", "year_type")
    return S.synthetic_series(years, P.templates(spark, "Sacramento"))


@check(V.query(f"""SELECT survival, threshold_cfs, round_even(threshold_cfs * factor, 0) AS scaled_cfs
FROM thresholds, (SELECT sum(x) / count(*) AS factor FROM (
    SELECT {sql_quotient('a', 'b')} AS x FROM (
      SELECT scenario, date, max(CASE WHEN place = 'NATION_9' THEN flow_cfs END) AS a,
             max(CASE WHEN place = 'NATION_7' THEN flow_cfs END) AS b
      FROM place_flow WHERE {IN_WINDOW} AND month(date) IN (5, 6, 7) GROUP BY 1, 2)))""",
               V.PLACE_FLOW,
               "thresholds AS (SELECT s::DOUBLE AS survival, t::DOUBLE AS threshold_cfs FROM (VALUES "
               + ", ".join(f"({s}, {t})" for s, t in maps.SURVIVAL_THRESHOLDS) + ") v(s, t))"))
def scale_thresholds(spark, sf):
    return P.survival_thresholds(V.place_flow(spark, sf, V.YEARS), "NATION_9", "NATION_7", FIRST, LAST)


_REACHES = ["NATION_11", "NATION_13", "NATION_19"]


@check(V.query("""SELECT scenario, date, place, CASE WHEN place = 'NATION_9' THEN new_cfs
  WHEN place IN ('NATION_11', 'NATION_13', 'NATION_19') THEN
    CASE WHEN flow_cfs + (new_cfs - old) < 0 THEN 100 ELSE flow_cfs + (new_cfs - old) END
  ELSE flow_cfs END AS flow_cfs
FROM (SELECT DISTINCT scenario, date, n_name AS place FROM place_flow, nation)
LEFT JOIN place_flow USING (scenario, date, place)
LEFT JOIN (SELECT scenario, date, flow_cfs AS old FROM place_flow WHERE place = 'NATION_9') USING (scenario, date)
LEFT JOIN (SELECT date, flow_cfs / 10 AS new_cfs FROM synthetic WHERE location = '1-URGENT' AND year < 2001)
  USING (date)""", V.PLACE_FLOW, V.YEAR_TYPES, _TEMPLATE, _SYNTHETIC), name="propagate_delta")
def propagate_delta_query(spark, sf):
    years = V.year_types(spark, sf).filter((F.col("location") == V.LOCATION) & (F.col("year") < 2001))
    new = P.synthetic_flow(years, "Sacramento").withColumn("new_cfs", F.col("new_cfs") / 10)
    places = [f"NATION_{i}" for i in range(25)]
    return propagate_delta(V.place_flow(spark, sf), new, "NATION_9", _REACHES, places=places)


_FIXED = ["NATION_10", "NATION_11"]


@check(V.query("""SELECT scenario, date, place, CAST(year(date) AS INTEGER) AS year,
  CASE WHEN place IN ('NATION_10', 'NATION_11') THEN 1 ELSE coalesce(CASE WHEN flow_cfs / junction_flow > 1 THEN 1
       ELSE flow_cfs / junction_flow END, 0) END AS value
FROM (SELECT f.scenario, f.date, f.place, f.flow_cfs, h.flow_cfs AS junction_flow
      FROM place_flow f LEFT JOIN junctions j USING (place)
      LEFT JOIN place_flow h ON h.scenario = f.scenario AND h.date = f.date AND h.place = j.junction
      WHERE month(f.date) = 10)""", V.PLACE_FLOW,
               """junctions AS (SELECT a.n_name AS place, b.n_name AS junction FROM nation a
  JOIN nation b ON b.n_nationkey = a.n_regionkey WHERE a.n_nationkey <> 24)"""), name="junction_ratio")
def junction_ratio_query(spark, sf):
    nation = V.table(spark, sf, "nation")
    hubs = nation.select(F.col("n_nationkey").alias("n_regionkey"), F.col("n_name").alias("junction"))
    junctions = nation.filter(F.col("n_nationkey") != 24).join(hubs, "n_regionkey").select(
        F.col("n_name").alias("place"), "junction"
    )
    return junction_ratio(V.place_flow(spark, sf), junctions, fixed=_FIXED)


@check("""SELECT scenario, part, count(x) AS n, round(median(x), 4) AS median
FROM (SELECT l_returnflag AS scenario, CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_suppkey END AS part, l_extendedprice AS x FROM lineitem)
GROUP BY 1, 2""")
def median_hot_group(spark, sf):
    """Medians of raw rows; one part holds those of most of the lines."""
    part = F.when(F.col("l_linenumber") <= 3, F.lit(0)).otherwise(F.col("l_suppkey")).cast("long")
    rows = V.shipped(spark, sf).select("scenario", part.alias("part"), F.col("l_extendedprice").alias("x"))
    return exact_median(rows, ["scenario", "part"], "x", ranges=64, few=500).withColumn("median", F.round("median", 4))


def _p(t: str) -> str:
    """A two-sided p value of t with n - 2 degrees of freedom: Simpson's rule over the density."""
    return f"""greatest(0, 1 - 2 * exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2)) / sqrt((n - 2) * pi()) * abs({t}) / 2000 / 3
      * list_sum(list_transform(generate_series(0, 2000), lambda i:
          (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + pow(i * {t} / 2000, 2) / (n - 2), -(n - 1) / 2))))"""


@check(f"""WITH m AS (
  SELECT l_returnflag AS scenario, l_suppkey AS node, CAST(regr_count(y, x) AS BIGINT) AS n, regr_avgx(y, x) AS mx, regr_avgy(y, x) AS my,
         regr_sxx(y, x) AS xx, regr_syy(y, x) AS yy, regr_sxy(y, x) AS xy
  FROM (SELECT l_returnflag, l_suppkey, l_extendedprice AS y, l_tax * 100 + 1000 AS x FROM lineitem) GROUP BY 1, 2),
f AS (SELECT *, xy / xx AS slope, my - xy / xx * mx AS intercept, sqrt((yy - xy / xx * xy) / (n - 2)) AS e, xy * xy / (xx * yy) AS r2 FROM m),
s AS (SELECT *, e / sqrt(xx) AS slope_error, e * sqrt(1 / n + mx * mx / xx) AS intercept_error FROM f),
t AS (SELECT *, slope / slope_error AS slope_t, intercept / intercept_error AS intercept_t FROM s)
SELECT scenario, node, round(slope, 4) AS slope, round(slope_error, 4) AS slope_error, round(slope_t, 6) AS slope_t, round({_p('slope_t')}, 6) AS slope_p,
  round(intercept, 2) AS intercept, round(intercept_error, 2) AS intercept_error, round(intercept_t, 6) AS intercept_t,
  round({_p('intercept_t')}, 6) AS intercept_p, round(e, 4) AS residual_error, round(r2, 8) AS r2,
  round(1 - (1 - r2) * (n - 1) / (n - 2), 8) AS adjusted_r2, round(slope * xy / (e * e), 6) AS f, n
FROM t""")
def regression_summary(spark, sf):
    """The price against the tax rate of each supplier's lines: no relation, so p values of all sizes."""
    lines = V.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("scenario"), F.col("l_suppkey").alias("node"), F.col("l_extendedprice").alias("y"), (F.col("l_tax") * 100 + 1000).alias("x")
    )
    fit = S.fit_summary(lines, F.col("y"), F.col("x"), ["scenario", "node"])
    digits = {"slope": 4, "slope_error": 4, "intercept": 2, "intercept_error": 2, "residual_error": 4, "r2": 8, "adjusted_r2": 8}
    names = [c for c in fit.columns if c not in ("scenario", "node", "n")]
    return fit.select("scenario", "node", *(F.round(c, digits.get(c, 6)).alias(c) for c in names), "n")
