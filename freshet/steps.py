"""Results between steps: written once below the session's shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below the one the session names in spark.checkpoint.dir or,
    where that is unset, below the warehouse. Every session has a warehouse, and
    all executors share both."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/freshet-{uuid.uuid4().hex}"


def kept(df: DataFrame, *by: str) -> DataFrame:
    """The rows as written, with no lineage left to repeat; in partitions ``by`` some columns."""
    path = scratch(df.sparkSession)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
