"""Published datasets on storage: one directory per dataset, one partition per scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.plans.maps import AVAILABLE
from freshet.sources import editions


def publish(df: DataFrame, root: str, dataset: str) -> str:
    """Write a dataset; only the scenarios it holds are replaced.

    Rows are clustered by scenario before the write, so a scenario ends in few
    files; adaptive execution splits the partition of a large scenario.
    """
    path = f"{root}/{dataset}"
    writer = df.hint("rebalance", "scenario").write.mode("overwrite").partitionBy("scenario")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def snapshot(df: DataFrame, path: str) -> str:
    """Write an intermediate result as it is."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def lookup(spark: SparkSession, root: str, dataset: str, scenario: str | None = None) -> DataFrame:
    """A published dataset, or one scenario of it (only that partition is read).

    Where there are editions, of the last one.
    """
    if editions.numbers(spark, root):
        return editions.lookup(spark, root, dataset, scenario)
    df = spark.read.parquet(f"{root}/{dataset}")
    return df if scenario is None else df.filter(F.col("scenario") == scenario)


def check_available(dataset: str, scenario: str) -> None:
    """Refuse a combination that is not published."""
    if scenario not in AVAILABLE.get(dataset, ()):
        raise KeyError(f"{dataset} is not published for {scenario}")


def register(spark: SparkSession, root: str, datasets=tuple(AVAILABLE)) -> None:
    """Make datasets available to SQL under their names."""
    for name in datasets:
        lookup(spark, root, name).createOrReplaceTempView(name)
