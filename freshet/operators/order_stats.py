"""Exact order statistics of groups of any size.

``F.median`` holds every value of a group in one task. Here a group is a bracket of
values and the ranks looked for in it. A round counts the values of each bracket in
equal ranges, which combines before the shuffle to ``ranges`` rows a group at most,
and goes on with the range that holds the ranks. Ranges follow from a function that
never falls as the value rises, and carry the least and largest value that they
hold, so rounding can move a border but not a rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.skew import spread_join
from freshet.steps import kept

RANGES = 1024
#: Values of a bracket that are sorted in one task.
FEW = 4096

INFINITE = float("inf")

#: What is left of a group: no values, one value, few values to sort, or a bracket to count.
NONE, SETTLED, FEW_LEFT, OPEN = 0, 1, 2, 3


def _place(x: Column, lo: Column, hi: Column, ranges: int) -> Column:
    """The range of x between lo and hi.

    A bracket of several magnitudes is divided by magnitude, as its values would
    else lie in one range. Halves are taken, so that no difference overflows.
    """

    def part(v: Column, a: Column, b: Column) -> Column:
        share = F.try_divide(v / 2 - a / 2, b / 2 - a / 2)
        # No difference is left of halves of the smallest numbers.
        return F.coalesce(F.least(F.floor(share * ranges), F.lit(ranges - 1)), F.when(v > a, ranges - 1).otherwise(0))

    def magnitude(v: Column) -> Column:
        # The smallest number has a logarithm of -744.
        return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ln(F.abs(v)) + 750))

    wide = magnitude(hi) - magnitude(lo) > 1
    return F.when(wide, part(magnitude(x), magnitude(lo), magnitude(hi))).otherwise(part(x, lo, hi))


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, strict: bool = True, ranges: int = RANGES, few: int = FEW
) -> DataFrame:
    """``(keys, n, median)`` of each group, whatever its size.

    As ``F.median`` over doubles: infinities count, NaN is the largest value and
    the mean of the two middle values is taken. Missing values are left out, or with
    ``strict`` make the median missing. Null keys are a group. The rows are read once
    for the brackets, once a round and once in the end; brackets of up to ``few``
    values are sorted. A round writes one row per group that is still open; with 1024
    ranges there are seven at most: two to one magnitude, five for the bits of a number.
    """
    keys = list(keys)
    renamed = [f"__key{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(r) for k, r in zip(keys, renamed, strict=True)), F.col(value).cast("double").alias("x"))
    # Null keys meet as well: joined by a text that tells null from all else.
    name = F.to_json(F.struct(*renamed)) if renamed else F.lit("")
    rows = rows.withColumn("g", name)
    x = F.col("x")
    usual = ~F.isnan(x) & (F.abs(x) < INFINITE)
    # Nothing is open of a group whose middle values are not among the usual ones.
    n, low, inside = F.col("n"), F.col("below"), F.col("inside")

    def odd(rank: Column) -> Column:
        above = F.when(rank < low + inside + F.col("high"), INFINITE).otherwise(float("nan"))
        return F.when(rank < low, -INFINITE).when(rank < low + inside, 0.0).otherwise(above)

    first, second = F.floor((n - 1) / 2), F.floor(n / 2)
    known = F.when((first < low) | (second >= low + inside), odd(first) * 0.5 + odd(second) * 0.5)
    none = (n == 0) | ((F.col("missing") > 0) & F.lit(strict))
    groups = rows.groupBy("g").agg(
        *(F.first(r).alias(r) for r in renamed), F.count("x").alias("n"), F.count_if(x.isNull()).alias("missing"),
        F.count_if(x == -INFINITE).alias("below"), F.count_if(usual).alias("inside"), F.count_if(x == INFINITE).alias("high"),
        F.min(F.when(usual, x)).alias("lo"), F.max(F.when(usual, x)).alias("hi"),
    )
    ends = [F.when(~none, F.coalesce(known, F.col(c))).alias(c) for c in ("lo", "hi")]
    state = F.when(none, NONE).when(known.isNotNull(), SETTLED).otherwise(_state(F.col("lo"), F.col("hi"), inside, few))
    groups = kept(groups.select("g", *renamed, "n", "below", *ends, state.alias("state")), "state")
    rows = rows.filter(usual).select("g", "x")
    tables = [groups.select("g", "n", "below", "lo", "hi", "state")]
    while not (large := tables[-1].filter(F.col("state") == OPEN)).isEmpty():
        met = spread_join(rows, large, ["g"], ["x"]).filter(x.between(F.col("lo"), F.col("hi")))
        counts = met.groupBy("g", _place(x, F.col("lo"), F.col("hi"), ranges).alias("place")).agg(
            F.count("*").alias("size"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.first("n").alias("n"), F.first("below").alias("below")
        )
        up = Window.partitionBy("g").orderBy("place")
        before = F.coalesce(F.sum("size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("below", F.col("below") + before).withColumn("after", F.lead("lo").over(up))
        hit = counts.filter((F.col("below") <= first) & (first < F.col("below") + F.col("size")))
        # The two ranks are neighbours: in two ranges they are the ends that face each other.
        split = F.when(second >= F.col("below") + F.col("size"), F.col("hi") * 0.5 + F.col("after") * 0.5)
        state = F.when(split.isNotNull(), SETTLED).otherwise(_state(F.col("lo"), F.col("hi"), F.col("size"), few))
        ends = [F.coalesce(split, F.col(c)).alias(c) for c in ("lo", "hi")]
        tables.append(kept(hit.select("g", "n", "below", *ends, state.alias("state")), "state"))

    def all_in(which: int) -> DataFrame:
        return reduce(DataFrame.unionByName, [t.filter(F.col("state") == which) for t in tables])

    at = spread_join(rows, all_in(FEW_LEFT), ["g"], ["x"]).filter(x.between(F.col("lo"), F.col("hi"))).groupBy("g").agg(
        F.sort_array(F.collect_list("x")).alias("v"), F.first("n").alias("n"), F.first("below").alias("below")
    )
    middle = [F.get("v", (rank - F.col("below")).cast("int")) * 0.5 for rank in (first, second)]
    found = at.select("g", (middle[0] + middle[1]).alias("median"))
    found = found.unionByName(all_in(SETTLED).select("g", F.col("lo").alias("median")))
    out = groups.select("g", *renamed, "n").join(found, "g", "left")
    return out.select(*(F.col(r).alias(k) for k, r in zip(keys, renamed, strict=True)), "n", "median")


def _state(lo: Column, hi: Column, size: Column, few: int) -> Column:
    return F.when(lo == hi, SETTLED).when(size <= few, FEW_LEFT).otherwise(OPEN)
