"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.shared import laid, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    edges: a, b. Large and small stars in turn: neighbours are tied to the
    smallest one among them until nothing changes, a number of rounds that grows
    with the logarithm of the nodes. A node with many neighbours is a minimum,
    combined before the shuffle, and a join that adaptive execution can split.
    Every round is a table in the shared folder; one with few edges is a single
    task's. Null ends and loops are left out.
    """
    tied = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    tied = laid(written(tied.filter("u is not null and v is not null and u <> v").distinct()))
    before = None
    while True:
        # Arrays in place of unions, which would spread a table that lies in one partition.
        ends = F.inline(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        both = tied.select(ends)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
        tied = laid(written(large.join(low, "u").select(moved).filter("u <> v").distinct()))
        # Equal counts and sums of hashes: the same edges as a round before.
        now = tied.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    pairs = F.inline(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component"))))
    return tied.select(pairs).distinct()
