"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: partition coalescing, broadcast by measured size,
    # splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One scenario can be replaced without touching the others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Exact medians group by place and month; their buffers hold a few values
    # each, so far more than the default 128 groups fit before sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "freshet") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
