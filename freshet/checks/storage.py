"""Files written and read back below the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.landing import write_exports
from freshet.checks.registry import check
from freshet.sources import exports, store

KEYS = ["scenario", "date"]


@check(V.query("SELECT scenario, node, count(*) AS n, sum(flow_cfs) AS flow_cfs FROM supplier_flow GROUP BY 1, 2",
               V.SUPPLIER_FLOW))
def csv_titled_scan(spark, sf):
    """Titled CSV: two title lines and a header above the data of every file."""
    flows = V.supplier_flow(spark, sf)
    data = flows.select(F.concat_ws(",", "scenario", F.date_format("date", "yyyy-MM-dd"), "node", "flow_cfs").alias("line"))
    titles = spark.createDataFrame(
        [("citation: some plan, action IV",), ('"some changes, possible",,',), ("scenario,date,node,flow_cfs",)], "line string"
    )
    path = f"{V.scratch(spark)}/titled"
    titles.unionByName(data).write.text(path)
    rows = exports.titled_csv(spark, path, "scenario string, date date, node long, flow_cfs double", "date")
    return rows.groupBy("scenario", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("flow_cfs").alias("flow_cfs"))


@check(V.query("""SELECT scenario, date, node, flow_cfs FROM node_flow
WHERE node IN ('N1', 'N3', 'N5') AND year(date) BETWEEN 1996 AND 2000""", V.NODE_FLOW))
def multi_file_scan(spark, sf):
    """Node exports, some files per scenario, with header rows above the data."""
    path = f"{V.scratch(spark)}/exports"
    write_exports(V.node_flow(spark, sf), V.NODES, path)
    rows = exports.node_export(spark, path, ["N1", "N3", "N5"], 1996, 2000)
    tagged = exports.scenario_of_file(rows, {f"scenario={s}": s for s in V.SCENARIOS})
    return tagged.filter(F.col("flow_cfs").isNotNull()).select(*KEYS, "node", "flow_cfs")


@check(V.query("""SELECT scenario, node, count(*) AS n, sum(CASE WHEN scenario = 'N' THEN flow_cfs + 1 ELSE flow_cfs END) AS flow_cfs
FROM supplier_flow GROUP BY 1, 2""", V.SUPPLIER_FLOW))
def partitioned_roundtrip(spark, sf):
    """Publish all scenarios, then replace one of them."""
    root = V.scratch(spark)
    flows = V.supplier_flow(spark, sf)
    store.publish(flows, root, "node_flow")
    store.publish(
        flows.filter(F.col("scenario") == "N").withColumn("flow_cfs", F.col("flow_cfs") + 1), root, "node_flow"
    )
    rows = store.lookup(spark, root, "node_flow")
    return rows.groupBy("scenario", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("flow_cfs").alias("flow_cfs"))


@check(V.query("SELECT date, node, flow_cfs FROM supplier_flow WHERE scenario = 'R'", V.SUPPLIER_FLOW))
def scenario_lookup(spark, sf):
    root = V.scratch(spark)
    store.publish(V.supplier_flow(spark, sf), root, "node_flow")
    return store.lookup(spark, root, "node_flow", "R").select("date", "node", "flow_cfs")


@check(V.query("SELECT scenario, date, place, flow_cfs FROM place_flow", V.PLACE_FLOW))
def snapshot_roundtrip(spark, sf):
    path = store.snapshot(V.place_flow(spark, sf), f"{V.scratch(spark)}/place_flow")
    return store.read_snapshot(spark, path)
