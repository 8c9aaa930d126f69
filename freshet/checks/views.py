"""The engine's input tables, derived from the driver tables.

Each view exists twice: as a DataFrame and as a SQL common table expression.
All of them aggregate whole tables; the raw rows combine before any shuffle,
so one hot key in them costs no more than any other.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshet.functions.dates import in_years
from freshet.operators.lookup import small_frame
from freshet.operators.lots import deal
from freshet.operators.reshape import to_wide
from freshet.plans import maps
from freshet.steps import scratch  # noqa: F401

NODES = [f"N{i}" for i in range(1, 8)]
SCENARIOS = ["A", "N", "R"]
YEARS = (1996, 2000)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once and then given."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def shipped(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Line items with scenario and month end; a year window reaches the scan."""
    rows = table(spark, sf, "lineitem")
    if years:
        rows = rows.filter(in_years("l_shipdate", *years))
    return rows.withColumn("date", F.last_day("l_shipdate")).withColumnRenamed("l_returnflag", "scenario")


def dealt(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The same, dealt by scenario, supplier and month: few lines each, so that partial sums would hardly be fewer."""
    return deal(shipped(spark, sf, years), ["scenario", "l_suppkey", "date"], table(spark, sf, "lineitem").count())


def node_flow(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    sums = (
        shipped(spark, sf, years)
        .groupBy("scenario", "date", "l_linenumber")
        .agg(F.sum("l_quantity").alias("flow_cfs"))
    )
    return sums.select("scenario", "date", F.concat(F.lit("N"), "l_linenumber").alias("node"), "flow_cfs")


NODE_FLOW = """node_flow AS (
  SELECT l_returnflag AS scenario, last_day(l_shipdate) AS date, 'N' || l_linenumber AS node,
         sum(l_quantity) AS flow_cfs
  FROM lineitem GROUP BY 1, 2, 3)"""


def supplier_flow(spark: SparkSession, sf: str, years: tuple[int, int] | None = None, lots: bool = False) -> DataFrame:
    """One node per supplier: the number of nodes grows with the data; in lots of bounded size if wanted."""
    return (
        (dealt if lots else shipped)(spark, sf, years)
        .groupBy("scenario", "date", F.col("l_suppkey").alias("node"))
        .agg(F.sum("l_quantity").alias("flow_cfs"))
    )


SUPPLIER_FLOW = """supplier_flow AS (
  SELECT l_returnflag AS scenario, last_day(l_shipdate) AS date, l_suppkey AS node,
         sum(l_quantity) AS flow_cfs
  FROM lineitem GROUP BY 1, 2, 3)"""


def node_places(spark: SparkSession, sf: str) -> DataFrame:
    """Node map: supplier to nation. It grows, so it carries no broadcast hint."""
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("node"), F.col("n_name").alias("place"), "n_regionkey", "n_nationkey")
    )


NODE_PLACES = """node_places AS (
  SELECT s_suppkey AS node, n_name AS place, n_regionkey, n_nationkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def place_flow(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Flow per nation and month: node sums, then the map, then place sums; names come last."""
    owners = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("key"))
    sums = (
        supplier_flow(spark, sf, years)
        .join(owners, "node")
        .groupBy("scenario", "date", "key")
        .agg(F.sum("flow_cfs").alias("flow_cfs"))
    )
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("place"))
    return sums.join(names, "key").select("scenario", "date", "place", "flow_cfs")


PLACE_FLOW = f"""{SUPPLIER_FLOW}, {NODE_PLACES}, place_flow AS (
  SELECT scenario, date, place, sum(flow_cfs) AS flow_cfs
  FROM supplier_flow JOIN node_places USING (node) GROUP BY 1, 2, 3)"""


def wide_nodes(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    return to_wide(node_flow(spark, sf, years), ["scenario", "date"], "node", "flow_cfs", NODES)


def _cases(column: str = "l_linenumber", value: str = "l_quantity") -> str:
    return ", ".join(f"sum(CASE WHEN {column} = {i} THEN {value} END) AS N{i}" for i in range(1, 8))


WIDE_NODES = f"""wide_nodes AS (
  SELECT l_returnflag AS scenario, last_day(l_shipdate) AS date, {_cases()}
  FROM lineitem GROUP BY 1, 2)"""


def basin_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A sparse wide table: seven nodes per supplier and month, many of them missing."""
    cells = [F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(f"N{i}") for i in range(1, 8)]
    return shipped(spark, sf).groupBy("scenario", F.col("l_suppkey").alias("basin"), "date").agg(*cells)


BASIN_WIDE = f"""basin_wide AS (
  SELECT l_returnflag AS scenario, l_suppkey AS basin, last_day(l_shipdate) AS date, {_cases()}
  FROM lineitem GROUP BY 1, 2, 3)"""


def second_source(spark: SparkSession, sf: str) -> DataFrame:
    """A second run: monthly order totals per priority, summed exactly."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.last_day("o_orderdate").alias("date"), F.col("o_orderpriority").alias("node"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("flow_cfs"))
    )


SECOND_SOURCE = """second_source AS (
  SELECT last_day(o_orderdate) AS date, o_orderpriority AS node,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS flow_cfs
  FROM orders GROUP BY 1, 2)"""


def year_types(spark: SparkSession, sf: str) -> DataFrame:
    """Water-year types: a year's order total against the median year of its priority."""
    yearly = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("location"), F.year("o_orderdate").alias("year"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    )
    # One row per year and location, so a window is as long as the record has years.
    middle = F.median("total").over(Window.partitionBy("location"))
    yearly = yearly.withColumn("idx", F.col("total") * 10 / middle)
    idx = F.col("idx")
    kind = (
        F.when(idx >= 10.2, "Wet")
        .when(idx >= 10, "Above Normal")
        .when(idx >= 9.8, "Below Normal")
        .when(idx >= 9, "Dry")
        .otherwise("Critical")
    )
    return yearly.select("location", "year", "idx", kind.alias("year_type"))


YEAR_TYPES = """yearly AS (
  SELECT o_orderpriority AS location, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders GROUP BY 1, 2),
middles AS (SELECT location, median(total) AS middle FROM yearly GROUP BY 1),
indexed AS (SELECT location, year, total * 10 / middle AS idx FROM yearly JOIN middles USING (location)),
year_types AS (
  SELECT location, year, idx,
         CASE WHEN idx >= 10.2 THEN 'Wet' WHEN idx >= 10 THEN 'Above Normal'
              WHEN idx >= 9.8 THEN 'Below Normal' WHEN idx >= 9 THEN 'Dry' ELSE 'Critical' END AS year_type
  FROM indexed)"""

LOCATION = "1-URGENT"


def _log_day():
    """Events cover 30 days; each of their hours stands for one day from 2009 on."""
    start = F.lit(dt.date(2024, 1, 1))
    hours = F.datediff(F.to_date("ts"), start) * 24 + F.hour("ts")
    return F.date_add(F.lit(dt.date(2009, 1, 1)), hours.cast("int"))


LOG_DAY = "(DATE '2009-01-01' + CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS INTEGER))"


def gate_log(spark: SparkSession, sf: str) -> DataFrame:
    """Gate operations: one gate per user, clicks open it, errors close it."""
    rows = table(spark, sf, "events").filter(F.col("event_type").isin("click", "error"))
    action = F.when(F.col("event_type") == "click", "Open").otherwise("Closed")
    return rows.select(F.col("user_id").alias("gate"), "event_id", action.alias("action"), _log_day().alias("date"))


GATE_LOG = f"""gate_log AS (
  SELECT user_id AS gate, event_id, CASE WHEN event_type = 'click' THEN 'Open' ELSE 'Closed' END AS action,
         {LOG_DAY} AS date
  FROM events WHERE event_type IN ('click', 'error'))"""


def daily_gauge(spark: SparkSession, sf: str) -> DataFrame:
    """Daily readings of one gauge per event type."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("gauge"), _log_day().alias("date"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("flow"))
    )


DAILY_GAUGE = f"""daily_gauge AS (
  SELECT event_type AS gauge, {LOG_DAY} AS date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS flow
  FROM events GROUP BY 1, 2)"""


def family_codes(family: str) -> list[str]:
    return maps.family_nodes(family)


def coded_flow(spark: SparkSession, sf: str, family: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Flows under a family's real node codes.

    Every line item counts: its part decides the node. 20 is taken off each sum
    and negatives become 0, so that zero flows and missing months both occur.
    """
    codes = family_codes(family)
    dim = small_frame(spark, list(enumerate(codes)), "slot int, node string")
    sums = (
        shipped(spark, sf, years)
        .groupBy("scenario", "date", F.pmod("l_partkey", F.lit(len(codes))).cast("int").alias("slot"))
        .agg(F.greatest(F.sum("l_quantity") - 20, F.lit(0.0)).alias("flow_cfs"))
    )
    return sums.join(dim, "slot").select("scenario", "date", "node", "flow_cfs")


def coded_flow_sql(family: str) -> str:
    codes = family_codes(family)
    values = ", ".join(f"({i}, '{c}')" for i, c in enumerate(codes))
    return f"""codes(slot, node) AS (VALUES {values}),
slots AS (
  SELECT l_returnflag AS scenario, last_day(l_shipdate) AS date, CAST(l_partkey % {len(codes)} AS INTEGER) AS slot,
         CASE WHEN sum(l_quantity) - 20 > 0 THEN sum(l_quantity) - 20 ELSE 0 END AS flow_cfs
  FROM lineitem GROUP BY 1, 2, 3),
coded AS (SELECT scenario, date, node, flow_cfs FROM slots JOIN codes USING (slot))"""


def _region(place: str) -> str:
    return place.lower().replace("-", "_").replace(" ", "_")


def tags() -> list[tuple[str, str, str]]:
    """(node, dataset, region) of a tagged run; a node may carry several tags."""
    out = []
    for place, _, node in maps.FLOW_NODES:
        out.append((node, "avg_flows", _region(place.rstrip("12"))))
    for _, segment, _, cell in maps.BYPASS_SEGMENTS:
        out += [(n, "bypass_flows", "spill" if segment == "sutter1" else segment) for n in maps.nodes(cell)]
    for measure, _, cell in maps.DELTA_NODES:
        dataset = "delta_inflows" if "inflow" in measure else "delta_diversions_total"
        region = "north_delta" if measure.startswith("n") else "south_delta"
        out += [(n, dataset, region) for n in maps.nodes(cell)]
    out += [("C_SAC257", "upsac_flow", "upsac"), ("C_SAC041", "freeport_flow", "freeport")]
    return out


def tagged_flow(spark: SparkSession, sf: str, years: tuple[int, int] | None = None) -> DataFrame:
    """A run whose rows name their dataset and region."""
    dim = small_frame(spark, tags(), "node string, dataset string, region string")
    return coded_flow(spark, sf, "action_5", years).join(dim, "node")


def values_cte(name: str, columns: list[str], rows: list[tuple]) -> str:
    """A literal table as a common table expression."""

    def literal(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def once(*ctes: str) -> list[str]:
    """Common tables that are computed once, for texts that refer to them several times."""
    return [re.sub(r"(^|\), )(\w+(?: ?\([^()]*\))?) AS \(", r"\1\2 AS MATERIALIZED (", cte) for cte in ctes]


def query(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body
