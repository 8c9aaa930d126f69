"""Functional-flow templates, volumes and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.dates import in_months, in_years
from freshet.functions.missing import quotient
from freshet.operators.lookup import small_frame
from freshet.operators.single import only
from freshet.operators.stats import annual_volume, scale_thresholds, synthetic_series, year_class
from freshet.plans import maps


def templates(spark: SparkSession, river: str, kind: str = "proposed", digits: int | None = None) -> DataFrame:
    """Monthly template flows: ``(year_type, month, flow_cfs)``."""
    rows = [
        (year_type, m + 1, round(float(v), digits) if digits is not None else float(v))
        for r, year_type, k, cell in maps.TEMPLATES
        if r == river and k == kind
        for m, v in enumerate(maps.nodes(cell))
    ]
    return small_frame(spark, rows, "year_type string, month int, flow_cfs double")


def classified_years(years: DataFrame) -> DataFrame:
    """Five water-year types as ``Wet`` and ``Dry``."""
    return years.withColumn("year_type", year_class("year_type", maps.WET_TYPES, ("Wet", "Dry")))


def dry_years(years: DataFrame, location: str, first: int, last: int) -> DataFrame:
    """Years of a location that are neither wet nor above normal."""
    return years.filter(
        (F.col("location") == location)
        & F.col("year").between(first, last)
        & ~F.col("year_type").isin(list(maps.WET_TYPES))
    ).select("year")


def synthetic_flow(years: DataFrame, river: str) -> DataFrame:
    """Synthetic monthly series of a river: ``(date, new_cfs)``."""
    series = synthetic_series(classified_years(years), templates(years.sparkSession, river))
    return series.select("date", F.col("flow_cfs").alias("new_cfs"))


def compare_volumes(model: DataFrame, natural: DataFrame, proposed: DataFrame) -> DataFrame:
    """Annual volume of a model year and two templates, each with ``flow_cfs`` rows."""
    tagged = [
        f.select("flow_cfs", F.lit(t).alias("type"))
        for f, t in zip((model, natural, proposed), maps.VOLUME_LABELS, strict=True)
    ]
    return annual_volume(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), ["type"])


def flow_ratios(
    flows: DataFrame, top: str, bottom: str, first: int = 1980, last: int = 2000, months=(5, 6, 7)
) -> DataFrame:
    """Monthly ratio of two places in a season, in one aggregate."""
    chosen = flows.filter(in_years("date", first, last) & in_months("date", months))
    a, b = (only(F.col("flow_cfs"), F.col("place") == p, "place") for p in (top, bottom))
    return chosen.groupBy("scenario", "date").agg(quotient(a, b).alias("value"))


def survival_thresholds(flows: DataFrame, top: str = maps.SAN_JOAQUIN, bottom: str = "Upper-mid Sacramento River",
                        first: int = 1980, last: int = 2000) -> DataFrame:
    """Sacramento thresholds scaled to another river by their mean flow ratio."""
    table = small_frame(flows.sparkSession, maps.SURVIVAL_THRESHOLDS, "survival double, threshold_cfs double")
    return scale_thresholds(table, flow_ratios(flows, top, bottom, first, last), "threshold_cfs", "scaled_cfs")
