"""Comparison of scenarios and consistency checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.single import only


def shared_places(df: DataFrame, scenarios: Sequence[str], key: str = "place") -> DataFrame:
    """Places present in every listed scenario: one aggregate instead of intersections."""
    flags = [
        F.max(F.when(F.col("scenario") == s, 1).otherwise(0)).alias(f"__{i}")
        for i, s in enumerate(scenarios)
    ]
    seen = df.filter(F.col("scenario").isin(list(scenarios))).groupBy(key).agg(*flags)
    for i in range(len(scenarios)):
        seen = seen.filter(F.col(f"__{i}") == 1)
    return seen.select(key)


def shared_rows(df: DataFrame, scenarios: Sequence[str], key: str = "place") -> DataFrame:
    """The rows of the places that every listed scenario has, in one pass.

    For aggregated rows: a place's window holds its dates in each scenario.
    """
    rows = df.filter(F.col("scenario").isin(list(scenarios)))
    place = Window.partitionBy(key)
    seen = [F.max(F.when(F.col("scenario") == s, 1).otherwise(0)).over(place) for s in scenarios]
    total = seen[0]
    for s in seen[1:]:
        total = total + s
    return rows.withColumn("__seen", total).filter(F.col("__seen") == len(scenarios)).drop("__seen")


def scenario_difference(
    df: DataFrame,
    left: str,
    right: str,
    keys: Sequence[str],
    value: str = "value",
    shared: str | None = None,
) -> DataFrame:
    """Two scenarios side by side with their difference, in one aggregate.

    Several rows of one scenario for the same keys are an error.

    ``shared`` names the place column: only places that both scenarios have are
    kept. That is decided on the aggregated rows, a place's window being as long
    as its dates, so the input is read once.
    """
    a, b = F.col("scenario") == left, F.col("scenario") == right
    wide = df.filter(a | b).groupBy(*keys).agg(
        only(F.col(value), a).alias("left_value"),
        only(F.col(value), b).alias("right_value"),
        F.max(F.when(a, 1).otherwise(0)).alias("__left"),
        F.max(F.when(b, 1).otherwise(0)).alias("__right"),
    )
    if shared is not None:
        place = Window.partitionBy(shared)
        wide = wide.withColumn("__both", F.max("__left").over(place) + F.max("__right").over(place))
        wide = wide.filter(F.col("__both") == 2)
    return wide.select(
        *keys, "left_value", "right_value", (F.col("right_value") - F.col("left_value")).alias("difference")
    )


def key_set_diff(df: DataFrame, left: str, right: str, keys: Sequence[str]) -> DataFrame:
    """Keys that only one of two scenarios has; empty when they agree."""
    seen = (
        df.filter(F.col("scenario").isin(left, right))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("scenario") == left, 1).otherwise(0)).alias("in_left"),
            F.max(F.when(F.col("scenario") == right, 1).otherwise(0)).alias("in_right"),
        )
    )
    lone = seen.filter(F.col("in_left") != F.col("in_right"))
    return lone.select(*keys, F.when(F.col("in_left") == 1, left).otherwise(right).alias("only_in"))


def long_cube(cube: DataFrame, variable: str) -> DataFrame:
    """Cube cells as tagged rows dated on the first of the month."""
    return cube.select(
        "scenario",
        F.lit(variable).alias("variable"),
        "place",
        F.make_date("year", "month", F.lit(1)).alias("date"),
        F.col("value").cast("double").alias("value"),
    )


def long_matrix(matrix: DataFrame, variable: str, prefix: str = "y") -> DataFrame:
    """Month x year matrices as tagged rows; the dataset of each row is its place."""
    years = [c for c in matrix.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]
    long = matrix.unpivot(["scenario", "dataset", "month"], years, "__year", "value")
    year = F.substring("__year", len(prefix) + 1, 4).cast("int")
    return long.select(
        "scenario",
        F.lit(variable).alias("variable"),
        F.col("dataset").alias("place"),
        F.make_date(year, F.col("month"), F.lit(1)).alias("date"),
        F.col("value").cast("double").alias("value"),
    )


def long_series(series: DataFrame, variable: str, value: str = "flow_cfs") -> DataFrame:
    """A dated place series as tagged rows."""
    return series.select(
        "scenario", F.lit(variable).alias("variable"), "place", "date", F.col(value).cast("double").alias("value")
    )
