"""Joins with a per-group table when one group may hold much of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from freshet.operators.single import one_row


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    how: str = "inner",
    salts: int = 8,
    parts: int | None = None,
) -> DataFrame:
    """Join rows with a table that has one row per ``keys``.

    Each group of rows is spread over ``salts`` partitions by a hash of ``by``
    and the table's row is repeated for each of them, so a hot group is not one
    task. Where the table turns out small the join is a broadcast. With ``parts`` the join has so many
    partitions, however few bytes they are.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    repeated = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if parts:
        salted, repeated = (side.repartition(parts, *keys, "__salt") for side in (salted, repeated))
    return salted.join(repeated, [*keys, "__salt"], how).drop("__salt")


#: Keys whose counts the frequent-items summary tracks; with more of them counts are upper bounds.
TRACKED_KEYS = 8192
#: Heavy groups asked of it.
MOST_HEAVY = 1000


def heavy_groups(rows: DataFrame, keys: Sequence[str], lots: int | None = None) -> dict[int, int]:
    """Groups that hold more than 1 / ``lots`` of the rows: the hash of their keys, and
    the number of such lots that they fill.

    One pass with a summary of bounded size, which partitions combine before they send
    it. ``lots`` is the number of shuffle partitions unless given. A summary that misses
    a group or overrates one costs balance and no result.
    """
    lots = lots or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = rows.select(F.xxhash64(*keys).alias("g"))
    top = F.expr(f"approx_top_k(g, {min(MOST_HEAVY, TRACKED_KEYS)}, {TRACKED_KEYS})")
    found = hashed.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    heavy = {item["item"]: item["count"] for item in found["top"] or []}
    return {g: -(-count * lots // found["n"]) for g, count in heavy.items() if count * lots > found["n"]}


def measured_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], by: Sequence[str], how: str = "inner", lots: int | None = None
) -> DataFrame:
    """``spread_join`` with the skew measured first: only heavy groups are spread, each
    over as many partitions as it fills, and only their rows of the table are repeated.

    Without a heavy group it is a plain join. The rows' keys are read once more.
    """
    heavy = heavy_groups(rows, keys, lots)
    if not heavy:
        return rows.join(table, list(keys), how)
    filled = F.create_map(*[F.lit(v).cast(t) for g, n in heavy.items() for v, t in ((g, "long"), (n, "int"))])
    salts = F.coalesce(F.try_element_at(filled, F.xxhash64(*keys)), F.lit(1))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*by), salts).cast("int"))
    repeated = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated, [*keys, "__salt"], how).drop("__salt")


def year_list(years: DataFrame) -> DataFrame:
    """Distinct years of the calendar, broadcast: 9,999 at most."""
    return F.broadcast(years.select("year").filter(F.col("year").between(1, 9999)).distinct())


def per_date(df: DataFrame, date: str = "date") -> DataFrame:
    """One row per date, broadcast: the type bounds them, one per day of the calendar.

    Several rows of one date are an error.
    """
    if not isinstance(df.schema[date].dataType, DateType):
        raise TypeError(f"{date} has to be a date, which bounds the rows that are broadcast")
    return F.broadcast(one_row(df, [date], "date"))
