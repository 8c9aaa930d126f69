"""Publications that are replaced, compared and revised."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check
from freshet.operators.digest import digest_diff as compare_digests
from freshet.sources import editions

_READ = """SELECT '{0}' AS dataset, scenario, CAST(count(*) AS BIGINT) AS n,
  sum(CASE WHEN scenario = 'N' THEN 2 * flow_cfs ELSE flow_cfs END) AS flow_cfs FROM {1} GROUP BY scenario"""


@check(V.query(_READ.format("node_flow", "supplier_flow") + " UNION ALL " + _READ.format("place_flow", "place_flow"), V.PLACE_FLOW))
def publish_all_roundtrip(spark, sf):
    """What users read after two editions and a run that failed between its datasets.

    The second edition replaces one scenario of both datasets; the failed one had
    written other values of a scenario and is not seen.
    """
    root = V.scratch(spark)
    nodes, places = V.supplier_flow(spark, sf), V.place_flow(spark, sf)
    editions.publish(spark, {"node_flow": nodes, "place_flow": places}, root)

    def changed(df: DataFrame, scenario: str, value) -> DataFrame:
        return df.filter(F.col("scenario") == scenario).withColumn("flow_cfs", value)

    double = F.col("flow_cfs") * 2
    editions.publish(spark, {"node_flow": changed(nodes, "N", double), "place_flow": changed(places, "N", double)}, root)
    try:
        with editions.draft(spark, root) as draft:
            draft.write("node_flow", changed(nodes, "A", F.lit(-1.0)))
            draft.write("place_flow", changed(places, "A", F.raise_error(F.lit("no place flows")).cast("double")))
    except PySparkException as e:
        if "no place flows" not in str(e):
            raise
    read = [editions.lookup(spark, root, name).select("scenario", "flow_cfs", F.lit(name).alias("dataset")) for name in ("node_flow", "place_flow")]
    rows = reduce(DataFrame.unionByName, read)
    return rows.groupBy("dataset", "scenario").agg(F.count("*").alias("n"), F.sum("flow_cfs").alias("flow_cfs"))


_REVISED = """revised AS (
  SELECT scenario, date, node, CASE WHEN node % 5 = 1 AND year(date) = 1994 THEN flow_cfs + 1 ELSE flow_cfs END AS flow_cfs
  FROM supplier_flow WHERE NOT (node % 7 = 3 AND year(date) = 1995)
  UNION ALL SELECT 'Z', date, node, flow_cfs FROM supplier_flow WHERE scenario = 'A' AND node % 9 = 2)"""


def _revised(flows: DataFrame) -> DataFrame:
    year = F.year("date")
    more = F.when((F.col("node") % 5 == 1) & (year == 1994), F.col("flow_cfs") + 1).otherwise(F.col("flow_cfs"))
    rest = flows.filter(~((F.col("node") % 7 == 3) & (year == 1995))).withColumn("flow_cfs", more)
    new = flows.filter((F.col("scenario") == "A") & (F.col("node") % 9 == 2)).withColumn("scenario", F.lit("Z"))
    return rest.unionByName(new)


@check(V.query("""SELECT coalesce(l.scenario, r.scenario) AS scenario, coalesce(l.date, r.date) AS date, coalesce(l.node, r.node) AS node,
  CASE WHEN l.node IS NULL THEN 'added' WHEN r.node IS NULL THEN 'removed' ELSE 'changed' END AS change,
  l.flow_cfs AS left_flow_cfs, r.flow_cfs AS right_flow_cfs
FROM supplier_flow l FULL JOIN revised r ON l.scenario = r.scenario AND l.date = r.date AND l.node = r.node
WHERE l.flow_cfs IS DISTINCT FROM r.flow_cfs""", V.SUPPLIER_FLOW, _REVISED))
def digest_diff(spark, sf):
    flows = V.supplier_flow(spark, sf)
    return compare_digests(flows, _revised(flows), ["scenario", "date", "node"], ["flow_cfs"])


@check(V.query("""SELECT l.scenario, l.date, l.node, 'changed' AS change, l.flow_cfs AS left_flow_cfs, r.flow_cfs AS right_flow_cfs
FROM supplier_flow l JOIN supplier_flow r USING (scenario, date, node) WHERE l.flow_cfs <> r.flow_cfs""", V.SUPPLIER_FLOW))
def digest_diff_equal(spark, sf):
    """A publication against itself, written in another order: told equal without a join of rows."""
    flows = V.supplier_flow(spark, sf)
    return compare_digests(flows, flows.orderBy(F.desc("node")), ["scenario", "date", "node"], ["flow_cfs"])


_PLACES = {"P": ["N1", "N2"], "Q": ["N3"], "R": ["N2", "N3", "N5"], "S": ["N7"]}
_TERMS = [("value", place, "num", node) for place, nodes in _PLACES.items() for node in nodes]
_NEWER = """newer AS (
  SELECT *, CASE WHEN scenario = 'N' AND node = 'N2' AND year(date) = 1996 AND month(date) IN (2, 3) THEN flow_cfs + 10
                 WHEN scenario = 'A' AND node = 'N7' AND year(date) = 1993 THEN NULL ELSE flow_cfs END AS flow FROM node_flow)"""


@check(V.query("""SELECT scenario, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, place,
  CASE WHEN count(flow) = any_value(wanted) THEN sum(flow) END AS value
FROM newer JOIN terms USING (node) GROUP BY scenario, year(date), month(date), place""", V.NODE_FLOW, _NEWER,
               V.values_cte("terms", ["place", "node", "wanted"], [(p, n, len(ns)) for p, ns in _PLACES.items() for n in ns])))
def revise_slice(spark, sf):
    """A cube kept up to date with runs that were replaced in some months of two years."""
    from freshet.operators.formula import formula_frame
    from freshet.plans import revision

    root = V.scratch(spark)
    flows = V.node_flow(spark, sf).select(
        "scenario", F.year("date").alias("year"), F.month("date").alias("month"), "node", "flow_cfs"
    )
    with editions.draft(spark, root) as draft:
        draft.write("inputs", flows, revision.BY)
        draft.write("cube", revision.cells(draft.read("inputs"), formula_frame(spark, _TERMS)), revision.BY)
    first = editions.lookup(spark, root, "inputs")
    more = (F.col("scenario") == "N") & (F.col("year") == 1996)
    lost = (F.col("scenario") == "A") & (F.col("year") == 1993)
    value = (
        F.when(more & (F.col("node") == "N2") & F.col("month").isin(2, 3), F.col("flow_cfs") + 10)
        .when(~(lost & (F.col("node") == "N7")), F.col("flow_cfs"))
    )
    with editions.draft(spark, root) as draft:
        draft.write("inputs", first.filter(more | lost).withColumn("flow_cfs", value), revision.BY)
    revision.revise_slice(spark, root, "cube", "inputs", 1, _TERMS)
    return editions.lookup(spark, root, "cube").select("scenario", "year", "month", "place", "value")
