"""Comparison of publications by digests.

A digest is a count and two sums of 64-bit hashes of rows: it does not depend on
the order of the rows, and digests of parts add up to that of the whole. Rows are
dealt to buckets by a hash of their keys. Publications are equal where their sums
over all buckets are; else only rows of buckets that differ are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.single import one_row

#: Leaves of the tree, and so the most that is taken to the driver.
BUCKETS = 4096
#: Leaves under a branch.
BRANCH = 64


def _hash(seed: int, columns: Sequence[str]) -> Column:
    # A missing value leaves a hash as it is, so its place is hashed as well.
    return F.xxhash64(F.lit(seed), *columns, *(F.col(c).isNull() for c in columns)).cast("decimal(20,0)")


def digests(df: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n, first, second)``: one row per bucket that has rows; combined before the shuffle."""
    columns = [*keys, *values]
    rows = df.select(bucket(keys, buckets).alias("bucket"), _hash(1, columns).alias("a"), _hash(2, columns).alias("b"))
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("a").cast("decimal(38,0)").alias("first"), F.sum("b").cast("decimal(38,0)").alias("second")
    )


def bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(_hash(0, keys), F.lit(buckets)).cast("int")


def branches(leaves: DataFrame, width: int = BRANCH) -> DataFrame:
    """The digests one level up: of the buckets that share a branch."""
    return leaves.groupBy(F.floor(F.col("bucket") / width).cast("int").alias("bucket")).agg(
        F.sum("n").alias("n"), F.sum("first").cast("decimal(38,0)").alias("first"), F.sum("second").cast("decimal(38,0)").alias("second")
    )


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ, ``buckets`` at most; each side is read once."""
    tagged = digests(left, keys, values, buckets).withColumn("side", F.lit(1))
    tagged = tagged.unionByName(digests(right, keys, values, buckets).withColumn("side", F.lit(-1)))
    sums = tagged.groupBy("bucket").agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "first", "second")))
    return sorted(r[0] for r in sums.filter("n <> 0 or first <> 0 or second <> 0").select("bucket").collect())


def digest_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``(keys, change, left_<value>, right_<value>)`` of rows that are not in both alike.

    change: added (only right), removed (only left) or changed. Equal sides are told
    by their digests, and no rows are joined. Repeated keys of a bucket that differs
    are an error. Missing values are equal to each other, NaN to NaN.
    """
    found = differing_buckets(left, right, keys, values, buckets)
    sides = []
    for df, name in ((left, "left"), (right, "right")):
        rows = df.filter(bucket(keys, buckets).isin(found)) if found else df.limit(0)
        rows = one_row(rows.select(*keys, *values), keys, f"key of the {name} side")
        sides.append(rows.select(*keys, F.struct(*values).alias(f"__{name}")))
    if not found:
        both = sides[0].withColumn("__right", F.col("__left"))
    else:
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        joined = sides[0].alias("l").join(sides[1].alias("r"), same, "full")
        there = F.col("__left").isNotNull()
        both = joined.select(*(F.when(there, F.col(f"l.{k}")).otherwise(F.col(f"r.{k}")).alias(k) for k in keys), "__left", "__right")
    change = F.when(F.col("__left").isNull(), "added").when(F.col("__right").isNull(), "removed").otherwise("changed")
    return both.filter(~F.col("__left").eqNullSafe(F.col("__right"))).select(
        *keys,
        change.alias("change"),
        *(F.col(f"__left.{v}").alias(f"left_{v}") for v in values),
        *(F.col(f"__right.{v}").alias(f"right_{v}") for v in values),
    )
