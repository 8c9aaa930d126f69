"""Projections, filters, expressions and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check, sql_finite, sql_kind, sql_policy, sql_quotient
from freshet.functions import dates as D
from freshet.functions.missing import POLICIES, clamp_nonneg, finite, quotient, settle_all
from freshet.functions.units import CMS_PER_CFS, LOWER_MID_REACHES, cfs_to_cms, weighted_blend
from freshet.operators.lookup import clip_to_range
from freshet.operators.reshape import fill_missing, mutate, take_prefix, to_long
from freshet.operators.stats import relabel

KEYS = ["scenario", "date"]


@check(V.query("SELECT scenario, date, node, flow_cfs FROM node_flow WHERE node IN ('N2', 'N5')", V.NODE_FLOW))
def node_subset(spark, sf):
    return V.node_flow(spark, sf).filter(F.col("node").isin("N2", "N5"))


@check(V.query("""SELECT scenario, date, node, flow_cfs FROM node_flow
WHERE year(date) BETWEEN 1996 AND 2000 AND month(date) IN (10, 11) AND scenario <> 'R'""", V.NODE_FLOW))
def window_filter(spark, sf):
    rows = V.node_flow(spark, sf, (1996, 2000))
    return rows.filter(D.in_months("date", (10, 11)) & (F.col("scenario") != "R"))


@check(V.query("SELECT scenario, basin, date, node, flow_cfs FROM (" + " UNION ALL ".join(
    f"SELECT scenario, basin, date, '{n}' AS node, {n} AS flow_cfs FROM basin_wide" for n in V.NODES
) + ") WHERE flow_cfs IS NOT NULL", V.BASIN_WIDE))
def drop_missing(spark, sf):
    long = to_long(V.basin_wide(spark, sf), ["scenario", "basin", "date"], V.NODES)
    return long.filter(F.col("flow_cfs").isNotNull())


@check(V.query("SELECT date, scenario AS run, N3 AS third, N1 + N2 AS upper FROM wide_nodes", V.WIDE_NODES))
def project_rename(spark, sf):
    return V.wide_nodes(spark, sf).select(
        "date", F.col("scenario").alias("run"), F.col("N3").alias("third"), (F.col("N1") + F.col("N2")).alias("upper")
    )


@check(V.query('SELECT scenario, date, N1 + N2 AS "Upper Reach", N3 AS "Lower Reach" FROM wide_nodes', V.WIDE_NODES))
def prefix_select(spark, sf):
    wide = V.wide_nodes(spark, sf).withColumn("div_Upper Reach", F.col("N1") + F.col("N2"))
    return take_prefix(wide.withColumn("div_Lower Reach", F.col("N3")), "div_", KEYS)


@check(V.query("""SELECT scenario, date, N2 + N1 AS s2, N3 + (N2 + N1) AS s3, N4 + (N3 + (N2 + N1)) AS s4
FROM wide_nodes""", V.WIDE_NODES))
def sequential_mutate(spark, sf):
    steps = [("s2", "N2 + N1"), ("s3", "N3 + s2"), ("s4", "N4 + s3")]
    return mutate(V.wide_nodes(spark, sf), steps).select(*KEYS, "s2", "s3", "s4")


@check(V.query(f"""SELECT scenario, date,
  {LOWER_MID_REACHES[0]!r}::DOUBLE * N3 + {LOWER_MID_REACHES[1]!r}::DOUBLE * N4 AS blended FROM wide_nodes""",
               V.WIDE_NODES), name="weighted_blend")
def weighted_blend_query(spark, sf):
    return V.wide_nodes(spark, sf).select(*KEYS, weighted_blend("N3", "N4").alias("blended"))


@check(V.query("""SELECT scenario, date, CASE WHEN node IN ('N1', 'N2', 'N3') THEN 'sutter1'
  WHEN node = 'N7' THEN 'yolo1' ELSE node END AS region, flow_cfs FROM node_flow""", V.NODE_FLOW))
def relabel_case(spark, sf):
    region = relabel("node", {"sutter1": ["N1", "N2", "N3"], "yolo1": ["N7"]})
    return V.node_flow(spark, sf).select(*KEYS, region.alias("region"), "flow_cfs")


@check(V.query(f"SELECT scenario, date, node, flow_cfs * {CMS_PER_CFS!r}::DOUBLE AS flow_cms FROM supplier_flow",
               V.SUPPLIER_FLOW), name="cfs_to_cms")
def cfs_to_cms_query(spark, sf):
    return V.supplier_flow(spark, sf).select(*KEYS, "node", cfs_to_cms("flow_cfs").alias("flow_cms"))


@check(V.query("SELECT scenario, basin, date, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in V.NODES)
               + " FROM basin_wide", V.BASIN_WIDE), name="fill_missing")
def fill_missing_query(spark, sf):
    return fill_missing(V.basin_wide(spark, sf), 0.0, V.NODES)


@check(V.query("""SELECT scenario, basin, date, CASE WHEN d < 0 THEN 0 ELSE d END AS flow,
  CASE WHEN q IS NULL THEN NULL WHEN isnan(q) OR q < 0 THEN 0 WHEN isinf(q) THEN NULL ELSE q END AS share
FROM (SELECT scenario, basin, date, N1 - N2 AS d, """ + sql_quotient("(N1 - 25)", "(N2 - 25)")
               + " AS q FROM basin_wide)", V.BASIN_WIDE), name="clamp_nonneg")
def clamp_nonneg_query(spark, sf):
    share = clamp_nonneg(quotient(F.col("N1") - 25, F.col("N2") - 25))
    return V.basin_wide(spark, sf).select(
        "scenario", "basin", "date", clamp_nonneg(F.col("N1") - F.col("N2")).alias("flow"), finite(share).alias("share")
    )


_SIDES = """parts AS (SELECT scenario, basin, date, N1 - 20 AS n,
  CASE WHEN N2 > 20 THEN N2 - 20 ELSE 0 END AS d_known, N2 FROM basin_wide),
sides AS (SELECT scenario, basin, date, n, CASE WHEN N2 IS NOT NULL THEN d_known END AS d FROM parts),
quotients AS (SELECT *, """ + sql_quotient("n", "d") + " AS x FROM sides)"


def _sides(spark, sf):
    """A numerator that may be negative or 0 over a denominator that is often 0 or missing."""
    low = F.when(F.col("N2") > 20, F.col("N2") - 20).when(F.col("N2").isNotNull(), F.lit(0.0))
    return V.basin_wide(spark, sf).select("scenario", "basin", "date", (F.col("N1") - 20).alias("n"), low.alias("d"))


@check(V.query("SELECT scenario, basin, date, " + ", ".join(
    f"{sql_finite('p_' + name)} AS {name}, {sql_kind('p_' + name)} AS {name}_kind" for name in POLICIES
) + " FROM (SELECT scenario, basin, date, " + ", ".join(
    f"{sql_policy('x', p)} AS p_{name}" for name, p in POLICIES.items()
) + " FROM quotients)", V.BASIN_WIDE, _SIDES))
def ratio_policies(spark, sf):
    rows = _sides(spark, sf).withColumn("x", quotient("n", "d"))
    settled = settle_all("x", POLICIES)
    out = [c for name, (value, of) in settled.items() for c in (value.alias(name), of.alias(f"{name}_kind"))]
    return rows.select("scenario", "basin", "date", *out)


@check("""SELECT DISTINCT l_returnflag AS scenario, last_day(l_shipdate) AS date, l_suppkey AS node,
  l_quantity AS flow FROM lineitem""")
def distinct_triples(spark, sf):
    rows = V.shipped(spark, sf)
    return rows.select(
        "scenario", "date", F.col("l_suppkey").alias("node"), F.col("l_quantity").alias("flow")
    ).distinct()


@check(V.query("""SELECT scenario, date, node, flow_cfs FROM node_flow
WHERE date BETWEEN (SELECT min(last_day(o_orderdate)) FROM orders WHERE o_orderdate >= DATE '1996-03-01'
                                                                    AND o_orderdate < DATE '1999-05-01')
          AND (SELECT max(last_day(o_orderdate)) FROM orders WHERE o_orderdate >= DATE '1996-03-01'
                                                                    AND o_orderdate < DATE '1999-05-01')""",
               V.NODE_FLOW))
def range_from_other(spark, sf):
    orders = V.table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= F.lit("1996-03-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1999-05-01").cast("timestamp_ntz"))
    )
    return clip_to_range(V.node_flow(spark, sf), orders.select(F.last_day("o_orderdate").alias("date")))


def _order_days(spark, sf):
    """Orders counted per day first: the calendar functions then see each day once."""
    days = V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    return days.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@check("""WITH shifted AS (SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 26 YEAR AS DATE) AS d FROM orders)
SELECT d AS read_date,
  CASE WHEN d >= DATE '2021-10-01' THEN last_day(CAST(last_day(d) - INTERVAL 100 YEAR AS DATE)) ELSE last_day(d) END AS date,
  CASE WHEN year(d) > 2023 THEN last_day(CAST(last_day(d) - INTERVAL 100 YEAR AS DATE)) ELSE last_day(d) END AS late_date,
  count(*) AS n
FROM shifted GROUP BY 1, 2, 3""", name="century_shift")
def century_shift_query(spark, sf):
    days = _order_days(spark, sf).select(F.add_months("date", 26 * 12).alias("read_date"), "n")
    # 29 February and its neighbour may meet in one read date.
    return days.groupBy("read_date").agg(F.sum("n").alias("n")).select(
        "read_date", D.century_shift("read_date").alias("date"), D.century_shift_after("read_date", 2023).alias("late_date"), "n"
    )


@check("""SELECT last_day(o_orderdate) AS date, CAST(day(last_day(o_orderdate)) AS INTEGER) AS n_days, count(*) AS n
FROM orders GROUP BY 1, 2""")
def month_end_date(spark, sf):
    rows = V.table(spark, sf, "orders").select(D.month_end("o_orderdate").alias("date"))
    return rows.groupBy("date", D.days_in_month("date").alias("n_days")).agg(F.count(F.lit(1)).alias("n"))


@check("""SELECT CAST(o_orderdate AS DATE) AS date,
  CASE WHEN month(o_orderdate) >= 10 THEN CAST(o_orderdate AS DATE)
       ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) END AS shifted,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year,
  count(*) AS n
FROM orders GROUP BY 1, 2, 3""", name="water_year_shift")
def water_year_shift_query(spark, sf):
    return _order_days(spark, sf).select(
        "date", D.water_year_shift("date").alias("shifted"), D.water_year("date").alias("water_year"), "n"
    )


@check("""SELECT strftime(o_orderdate, '%b') AS month, CAST((month(o_orderdate) + 2) % 12 + 1 AS INTEGER) AS water_month,
  CAST(month(o_orderdate) AS INTEGER) AS month_index, count(*) AS n FROM orders GROUP BY 1, 2, 3""",
       name="water_month")
def water_month_query(spark, sf):
    rows = V.table(spark, sf, "orders").select(
        D.month_abb(F.month("o_orderdate")).alias("month"), D.water_month("o_orderdate").alias("water_month")
    )
    return rows.groupBy("month", "water_month", D.month_index("month").alias("month_index")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("""WITH days AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT date, date AS from_export, CAST(date_trunc('month', date) AS DATE) AS from_parts, CAST(NULL AS DATE) AS from_junk,
  date AS from_slashes, CAST(date - INTERVAL 24 YEAR AS DATE) AS from_short_year, count(*) AS n
FROM days GROUP BY date""")
def date_parse(spark, sf):
    day = F.col("date")
    text = _order_days(spark, sf).select(
        "date",
        F.date_format(day, "ddMMMyyyy").alias("export"),
        F.date_format(day, "M/d/yyyy").alias("slashes"),
        F.date_format(F.add_months(day, -24 * 12), "M/d/yy").alias("short"),
        "n",
    )
    return text.select(
        "date",
        D.parse_date("export", D.EXPORT_DATE).alias("from_export"),
        D.parse_date("slashes", "M/d/yyyy").alias("from_slashes"),
        F.make_date(F.year("date"), F.month("date"), F.lit(1)).alias("from_parts"),
        D.parse_date(F.concat(F.lit("x"), "export"), D.EXPORT_DATE).alias("from_junk"),
        D.parse_short_year("short").alias("from_short_year"),
        "n",
    )
