"""Lookups, overrides and splices.

Maps given as Python values are small by construction and are broadcast. Maps
given as DataFrames may grow with the data; their joins carry no hint, so the
planner broadcasts them only below its size threshold and otherwise shuffles,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.single import one_row
from freshet.operators.skew import per_date, year_list

# A literal map beyond this is a table and has to be passed as one.
MAX_LITERAL_ROWS = 10_000
ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
}


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table, marked for broadcast; its size is checked here.

    An Arrow table becomes a local relation, which needs no tasks to be read.
    """
    if len(rows) > MAX_LITERAL_ROWS:
        raise ValueError(f"{len(rows)} literal rows; pass a DataFrame instead")
    fields = [f.split() for f in schema.split(",")]
    columns = [pa.array([r[i] for r in rows], ARROW_TYPES[kind]) for i, (_, kind) in enumerate(fields)]
    local = pa.Table.from_arrays(columns, names=[name for name, _ in fields])
    return F.broadcast(spark.createDataFrame(local, schema))


def lookup_label(df: DataFrame, labels: Mapping[str, str], key: str, label: str) -> DataFrame:
    """Add ``label`` from a literal map; an unknown key gives NULL."""
    dim = small_frame(df.sparkSession, list(labels.items()), f"{key} string, {label} string")
    return df.join(dim, key, "left")


def map_nodes(flows: DataFrame, node_map: DataFrame, key: str = "node") -> DataFrame:
    """Inner join on the node; a node that feeds several places gives several rows."""
    return flows.join(node_map, key)


def by_dimension(df: DataFrame, dim: DataFrame, key: str = "place") -> DataFrame:
    """Attach a dimension (for instance the publication order of places)."""
    return df.join(dim, key, "left")


def replace_series(
    flows: DataFrame,
    source: DataFrame,
    place: str,
    keys: Sequence[str] = ("scenario", "date"),
    key: str = "place",
    value: str = "flow_cfs",
    keep_old: bool = False,
) -> DataFrame:
    """Take one place's values from another source, joined on ``keys``.

    A key the source lacks becomes missing, unless ``keep_old``. Several rows of
    the source for one key are an error. One join over one scan: the place is
    part of its key.
    """
    source = source.select(*keys, value)
    source = per_date(source) if list(keys) == ["date"] else one_row(source, keys)
    new = source.select(*keys, F.lit(place).alias(key), F.col(value).alias("__new"))
    joined = flows.join(new, [*keys, key], "left")
    taken = F.coalesce("__new", value) if keep_old else F.col("__new")
    return joined.withColumn(value, F.when(F.col(key) == place, taken).otherwise(F.col(value))).select(*flows.columns)


def splice_by_year(inside: DataFrame, outside: DataFrame, years: DataFrame, date: str = "date") -> DataFrame:
    """Rows of ``inside`` in the listed years and of ``outside`` in all others."""
    key = year_list(years)
    a = inside.withColumn("year", F.year(date)).join(key, "year", "left_semi").drop("year")
    b = outside.withColumn("year", F.year(date)).join(key, "year", "left_anti").drop("year")
    return a.unionByName(b)


def merge_sources(sources: Sequence[DataFrame], keys: Sequence[str], value: str = "flow_cfs") -> DataFrame:
    """Outer merge of several sources; where keys repeat, the earlier source wins.

    An aggregate instead of a window: it combines before the shuffle.
    """
    ranked = [s.select(*keys, value, F.lit(i).alias("__rank")) for i, s in enumerate(sources)]
    stacked = ranked[0]
    for frame in ranked[1:]:
        stacked = stacked.unionByName(frame)
    return stacked.groupBy(*keys).agg(F.min_by(value, "__rank").alias(value))


def merge_rules(df: DataFrame, sources: Sequence[tuple[Column, Column]], keys: Sequence[str], value: str = "flow_cfs") -> DataFrame:
    """The same for sources that are rules over one frame, ``(which rows, their value)``: one scan.

    A row of several sources counts for the earliest.
    """
    rank, taken = F.lit(None).cast("int"), F.lit(None)
    for i, (rows, expr) in reversed(list(enumerate(sources))):
        rank, taken = F.when(rows, F.lit(i)).otherwise(rank), F.when(rows, expr).otherwise(taken)
    ranked = df.select(*keys, taken.alias(value), rank.alias("__rank")).filter(F.col("__rank").isNotNull())
    return ranked.groupBy(*keys).agg(F.min_by(value, "__rank").alias(value))


def full_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys; a clashing column gets ``_x`` and ``_y``."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    for name in clash:
        left = left.withColumnRenamed(name, f"{name}_x")
        right = right.withColumnRenamed(name, f"{name}_y")
    return left.join(right, list(keys), "full")


def calendar_remap(series: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Put a series on a second calendar.

    ``calendar(cl_date, cs_date)`` names for each target month the month to read.
    Both sides are snapped to the first of the month; unmatched target months stay.
    """
    target = calendar.select("cl_date", F.trunc("cs_date", "month").alias("__month"))
    source = series.withColumn("__month", F.trunc(date, "month")).drop(date)
    return target.join(source, "__month", "left").withColumnRenamed("__month", "cs_date")


def clip_to_range(df: DataFrame, other: DataFrame, date: str = "date") -> DataFrame:
    """Keep the rows within the date range of another frame.

    The range is one scalar row, evaluated once as a subquery.
    """
    span = other.select(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
    return df.filter(F.col(date).between(span.getField("lo"), span.getField("hi")))
