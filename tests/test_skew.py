"""Groups that hold much of the rows: found by a bounded summary, spread in proportion."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freshet.operators import sequence as Q
from freshet.operators import skew


def hashed(spark, *values):
    frame = spark.createDataFrame([(v,) for v in values], "g string").select("g", F.xxhash64("g").alias("h"))
    return {r["g"]: r["h"] for r in frame.collect()}


def skewed(spark):
    """A third of the rows in one group, a sixth in another, the rest in 20,000 groups."""
    i = F.col("id")
    group = F.when(i % 3 == 0, F.lit("hot")).when(i % 6 == 1, F.lit("warm")).otherwise((i % 20000).cast("string"))
    return spark.range(60000).select(i.alias("i"), group.alias("g"), (i % 7 + 1).cast("double").alias("flow_cfs"))


def test_heavy_groups_are_found_in_proportion(spark):
    names = hashed(spark, "hot", "warm")
    found = skew.heavy_groups(skewed(spark), ["g"], 24)
    assert set(found) == set(names.values())
    assert 8 <= found[names["hot"]] <= 10 and 4 <= found[names["warm"]] <= 6
    assert skew.heavy_groups(skewed(spark).filter("g not in ('hot', 'warm')"), ["g"], 24) == {}
    assert skew.heavy_groups(skewed(spark).limit(0), ["g"], 24) == {}


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_measured_join_equals_a_plain_one(spark, threshold):
    table = spark.createDataFrame([("hot", 1), ("warm", 2), ("4", 3), ("other", 4)], "g string, x int")
    rows = skewed(spark).unionByName(spark.createDataFrame([(-1, None, 0.0), (-2, None, None)], "i long, g string, flow_cfs double"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for how in ("inner", "left"):
            got = skew.measured_join(rows, table, ["g"], ["i"], how, 24)
            want = rows.join(table, ["g"], how)
            assert got.columns == want.columns
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_heavy_groups_are_repeated(spark):
    even = spark.range(4000).select(F.col("id").alias("i"), (F.col("id") % 400).alias("g"), F.lit(1.0).alias("flow_cfs"))
    plan = Q.share_of_total(even, ["g"], salts=None)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "__salt" not in plan
    plan = Q.share_of_total(skewed(spark), ["g"], salts=None)._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def test_shares_of_measured_groups(spark):
    out = Q.share_of_total(skewed(spark), ["g"], salts=None)
    assert out.count() == 60000
    for r in out.groupBy("g").agg(F.sum("share").alias("s")).filter("g in ('hot', 'warm', '4')").collect():
        assert r["s"] == pytest.approx(1.0)
