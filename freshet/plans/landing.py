"""Model output files to the engine's long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.dates import century_shift, century_shift_after, month_end
from freshet.plans import maps
from freshet.sources import exports

TAGGED = "datetime timestamp, node string, dataset string, region string, values double, units string"


def land_exports(
    spark: SparkSession,
    paths: str | Sequence[str],
    scenario: str,
    family: str = "calsim2",
    first: int = 1922,
    last: int = 2002,
    date_format: str = exports.EXPORT_DATE,
    misread_after: int | None = None,
) -> DataFrame:
    """Export files of one run as ``(scenario, date, node, flow_cfs)``.

    Only the nodes the family's formulas use are kept. Where two files have the
    same node and month, the file that sorts first wins. ``misread_after`` repairs
    dates read a century late in runs whose record ends in that year.
    """
    window = (first, last) if misread_after is None else (None, None)
    rows = exports.node_export(spark, paths, maps.family_nodes(family), *window, date_format=date_format)
    if misread_after is not None:
        rows = rows.withColumn("date", century_shift_after("date", misread_after))
        rows = rows.filter(F.year("date").between(first, last))
    merged = rows.groupBy("date", "node").agg(F.min_by("flow_cfs", "file").alias("flow_cfs"))
    return merged.select(F.lit(scenario).alias("scenario"), "date", "node", "flow_cfs")


def land_wide(wide: DataFrame, scenario: str, label: str = "B", date: str = "date") -> DataFrame:
    """A wide run (a label, a date and one column per node); a late century is repaired, gaps are dropped."""
    nodes = [c for c in wide.columns if c not in (label, date)]
    dated = wide.withColumn(date, century_shift(month_end(F.col(date).cast("date"))))
    long = dated.unpivot([date], nodes, "node", "flow_cfs").filter(F.col("flow_cfs").isNotNull())
    return long.select(F.lit(scenario).alias("scenario"), F.col(date).alias("date"), "node", "flow_cfs")


def land_tagged(spark: SparkSession, paths: str | Sequence[str], scenario: str = "action_5") -> DataFrame:
    """A tagged run, whose rows name their dataset and region."""
    rows = exports.titled_csv(spark, paths, TAGGED, "datetime")
    return rows.select(
        F.lit(scenario).alias("scenario"),
        month_end(F.col("datetime").cast("date")).alias("date"),
        "node", "dataset", "region", F.col("values").alias("flow_cfs"),
    )


def land_east_side(wide: DataFrame, scenario: str, date: str = "Date") -> DataFrame:
    """The separate east-side run from its wide sheet."""
    nodes = [maps.MOKELUMNE_FLOW, *maps.MOKELUMNE_DIVERSIONS]
    long = wide.select(month_end(F.col(date).cast("date")).alias("date"), *nodes).unpivot(
        ["date"], nodes, "node", "flow_cfs"
    )
    return long.select(F.lit(scenario).alias("scenario"), "date", "node", "flow_cfs")
