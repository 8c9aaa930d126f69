"""Ratio policies and aggregates that propagate missing values."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.functions import missing as M

INF, NAN = math.inf, math.nan
SIDES = [(None, 1.0), (1.0, None), (None, None), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (1.0, 4.0),
         (-1.0, 4.0), (2.0, 2.0), (NAN, 1.0), (NAN, 0.0), (1.0, NAN), (0.0, 5.0)]


def expected(n, d, p):
    """The rule written out for one pair."""
    if n is None or d is None:
        x = None
    elif d == 0:
        x = NAN if n == 0 or math.isnan(n) else math.copysign(INF, n)
    else:
        x = n / d
    if x is None:
        out = None
    elif math.isnan(x):
        out = x if p.on_nan == M.KEEP else p.on_nan
    elif x == INF:
        out = (p.cap if p.cap is not None else x) if p.on_inf == M.KEEP else p.on_inf
    elif x == -INF:
        out = x if p.on_neg_inf == M.KEEP else p.on_neg_inf
    else:
        x = round(x, p.digits) if p.digits is not None else x
        out = p.cap if p.cap is not None and x > p.cap else x
    return p.on_null if out is None and p.on_null is not None else out


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return (math.isnan(a) and math.isnan(b)) or a == b


def test_every_policy_on_every_edge_case(spark):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(SIDES)], "i int, n double, d double")
    out = df.select("i", *[M.ratio("n", "d", p).alias(name) for name, p in M.POLICIES.items()]).collect()
    for row in out:
        n, d = SIDES[row["i"]]
        for name, p in M.POLICIES.items():
            assert same(row[name], expected(n, d, p)), (name, n, d, row[name])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5).map(float)), st.one_of(st.none(), st.integers(-5, 5).map(float))),
                min_size=1, max_size=40))
def test_capped_policies_stay_in_bounds(spark, pairs):
    df = spark.createDataFrame(pairs, "n double, d double")
    value = M.ratio("n", "d", M.DIVERTED_CAP_FIRST).alias("v")
    for (n, d), row in zip(pairs, df.select(value).collect()):
        assert same(row["v"], expected(n, d, M.DIVERTED_CAP_FIRST))
        assert row["v"] <= 1


def test_cap_clamp_and_kind(spark):
    df = spark.createDataFrame([(None,), (NAN,), (INF,), (-INF,), (2.0,), (-2.0,)], "x double")
    out = df.select(M.cap("x", 1).alias("c"), M.clamp_nonneg("x").alias("z"), M.kind("x").alias("k"),
                    M.finite_or("x", 7).alias("f")).collect()
    assert [r["k"] for r in out] == ["missing", "nan", "inf", "-inf", "finite", "finite"]
    assert out[0]["c"] is None and math.isnan(out[1]["c"]) and out[2]["c"] == 1 and out[5]["c"] == -2
    assert [r["z"] for r in out] == [None, 0.0, INF, 0.0, 2.0, 0.0]
    assert [r["f"] for r in out] == [7.0, 7.0, 7.0, 7.0, 2.0, -2.0]


@pytest.mark.parametrize("values,total,mean,sd,median", [
    ([1.0, 3.0], 4.0, 2.0, math.sqrt(2), 2.0),
    ([1.0, None], None, None, None, None),
    ([5.0], 5.0, 5.0, None, 5.0),
    ([4.0, 1.0, 3.0, 2.0], 10.0, 2.5, math.sqrt(5 / 3), 2.5),
])
def test_strict_aggregates(spark, values, total, mean, sd, median):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.agg(M.strict_sum("x").alias("t"), M.strict_mean("x").alias("m"), M.strict_sd("x").alias("s"),
                 M.strict_median("x").alias("d")).first()
    for got, want in zip(row, (total, mean, sd, median)):
        assert got is None if want is None else got == pytest.approx(want)


def test_strict_sum_of_zero_denominators_does_not_raise(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "n double, d double")
    assert df.filter(F.isnan(M.quotient("n", "d"))).count() == 1


def test_policies_settled_together_agree_with_each_alone(spark):
    policies = M.POLICIES | {"capped_inf": M.RatioPolicy(cap=2.0), "kept_null": M.RatioPolicy(on_nan=None, on_neg_inf=INF)}
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(SIDES)], "i int, n double, d double")
    x = df.withColumn("x", M.quotient("n", "d"))
    columns = []
    for name, (value, of) in M.settle_all("x", policies).items():
        alone = M.settle("x", policies[name])
        columns += [(value.eqNullSafe(M.finite(alone)) & of.eqNullSafe(M.kind(alone))).alias(name)]
    for row in x.select("i", *columns).collect():
        assert all(row[name] for name in policies), (SIDES[row["i"]], row)
