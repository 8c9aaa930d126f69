"""Model output written as the models export it, and landed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.checks import views as V
from freshet.checks.registry import check
from freshet.functions.dates import EXPORT_DATE
from freshet.operators.lookup import small_frame
from freshet.plans import landing, maps

#: Files of a scenario and export, each with its own header rows.
PARTS = 2


def write_exports(flows: DataFrame, nodes: Sequence[str], path: str, export: str = "a", number=lambda c: c.cast("string")) -> None:
    """An export of (scenario, date, node, flow_cfs): header rows, then a line a month.

    Years are dealt to PARTS files a scenario, so that no task writes one whole. A
    month's cells are one line, also where all those of the named nodes are missing.
    """
    part = F.pmod(F.year("date"), F.lit(PARTS)).alias("part")
    cell = F.struct("node", F.coalesce(number(F.col("flow_cfs")), F.lit("")))
    months = flows.groupBy("scenario", "date").agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    values = F.transform(F.array(*map(F.lit, nodes)), lambda n: F.coalesce(F.try_element_at("cells", n), F.lit("")))
    line = F.concat_ws(",", F.lit("1"), F.date_format("date", EXPORT_DATE), F.array_join(values, ","))
    head = ["A,," + ",".join("MODEL" for _ in nodes), "B,," + ",".join(nodes), "Units,," + ",".join("CFS" for _ in nodes)]
    heads = months.select("scenario", part).distinct().select("*", F.explode(F.array(*map(F.lit, head))).alias("line"))
    rows = heads.unionByName(months.select("scenario", part, line.alias("line"))).withColumn("export", F.lit(export))
    rows.repartition("scenario", "part").write.mode("append").partitionBy("scenario", "export", "part").text(path)


def thousands(value: Column) -> Column:
    """Numbers from 1,000 on as spreadsheets export them: with commas, in quotes."""
    return F.when(value >= 1000, F.concat(F.lit('"'), F.format_number(value, 1), F.lit('"'))).otherwise(value.cast("string"))


FAMILY = "calsim2"
NODES = maps.family_nodes(FAMILY)
FIRST, LAST = 1993, 1997
#: Two exports of a run that have some nodes in common.
UPPER, LOWER = NODES[: 2 * len(NODES) // 3], NODES[len(NODES) // 3 :]


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


@check(V.query(f"""SELECT scenario, date, node,
  CASE WHEN node IN ({_quoted(UPPER)}) THEN flow_cfs ELSE flow_cfs + 1 END AS flow_cfs
FROM (SELECT scenario, date, node FROM (SELECT DISTINCT scenario, date FROM coded), codes
      WHERE year(date) BETWEEN {FIRST} AND {LAST}) LEFT JOIN coded USING (scenario, date, node)""", V.coded_flow_sql(FAMILY)))
def land_exports(spark, sf):
    """Two exports a run; of nodes in both the first file's months count."""
    root = V.scratch(spark)
    flows = V.coded_flow(spark, sf, FAMILY)
    write_exports(flows, UPPER, root, "a", thousands)
    write_exports(flows.withColumn("flow_cfs", F.col("flow_cfs") + 1), LOWER, root, "b", thousands)
    runs = [landing.land_exports(spark, f"{root}/scenario={s}", s, FAMILY, FIRST, LAST) for s in V.SCENARIOS]
    return reduce(DataFrame.unionByName, runs)


@check(V.query("""SELECT scenario, date, node, flow_cfs
FROM (SELECT scenario, CASE WHEN year(date) >= 1996 THEN last_day(make_date(year(date) - 70, month(date), 1)) ELSE date END AS date,
             node, flow_cfs FROM node_flow)""", V.NODE_FLOW))
def land_wide(spark, sf):
    """A wide run per scenario whose years from 1996 on were read as 2026 and later."""
    wide = V.wide_nodes(spark, sf)
    late = F.last_day(F.add_months("date", 360))
    misread = wide.withColumn("date", F.when(F.year("date") >= 1996, late).otherwise(F.col("date"))).withColumn("B", F.lit("1"))
    runs = [landing.land_wide(misread.filter(F.col("scenario") == s).drop("scenario"), s) for s in V.SCENARIOS]
    return reduce(DataFrame.unionByName, runs)


@check(V.query("SELECT scenario, date, node, dataset, region, flow_cfs FROM coded JOIN tags USING (node)",
               V.coded_flow_sql("action_5"), V.values_cte("tags", ["node", "dataset", "region"], V.tags())))
def land_tagged(spark, sf):
    """Tagged rows of each scenario in files with a title and a header."""
    root = V.scratch(spark)
    rows = V.tagged_flow(spark, sf)
    time = F.date_format("date", "yyyy-MM-dd'T'00:00:00'Z'")
    line = F.concat_ws(",", time, "node", "dataset", "region", F.col("flow_cfs").cast("string"), F.lit("CFS"))
    head = ["monthly flows, all regions", "datetime,node,dataset,region,values,units"]
    titles = small_frame(spark, [(s, h) for s in V.SCENARIOS for h in head], "scenario string, line string")
    titles.unionByName(rows.select("scenario", line.alias("line"))).write.partitionBy("scenario").text(root)
    runs = [landing.land_tagged(spark, f"{root}/scenario={s}", s) for s in V.SCENARIOS]
    return reduce(DataFrame.unionByName, runs)


_SHEET = [maps.MOKELUMNE_FLOW, *maps.MOKELUMNE_DIVERSIONS]


@check(V.query(" UNION ALL ".join(
    f"SELECT 'east' AS scenario, date, '{n}' AS node, N{i} AS flow_cfs FROM wide_nodes WHERE scenario = 'N'" for i, n in enumerate(_SHEET, 1)
), V.WIDE_NODES))
def land_east_side(spark, sf):
    """The east-side sheet, dated at the first of the month; missing cells stay."""
    wide = V.wide_nodes(spark, sf).filter("scenario = 'N'")
    sheet = wide.select(F.trunc("date", "month").alias("Date"), *(F.col(f"N{i}").alias(n) for i, n in enumerate(_SHEET, 1)))
    return landing.land_east_side(sheet, "east")
