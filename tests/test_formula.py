"""Formula evaluation and apportionment against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from freshet.functions import missing as M
from freshet.operators import formula as R

TERMS = [
    ("m", "A", "num", "x", 1.0), ("m", "A", "num", "y", 0.5), ("m", "A", "den", "z", 1.0),
    ("m", "B", "num", "y", 1.0), ("m", "B", "den", "y", 1.0), ("m", "B", "den", "x", 1.0),
]


def sparse(seed):
    rng = random.Random(seed)
    out = []
    for month in range(1, 13):
        d = dt.date(1990, month, 28)
        for node in "xyz":
            roll = rng.random()
            if roll < 0.2:
                continue
            out.append(("s", d, node, None if roll < 0.35 else float(rng.randrange(0, 3))))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sums_and_ratios(spark, seed):
    data = sparse(seed)
    flows = spark.createDataFrame(data, "scenario string, date date, node string, flow_cfs double")
    formulas = R.formula_frame(spark, TERMS)
    value = {(d, n): v for _, d, n, v in data}
    got = {(r["date"], r["place"]): r for r in R.formula_ratio(flows, formulas, M.DIVERTED_CAP_FIRST).collect()}
    loose = {(r["date"], r["place"]): r["num"] for r in R.formula_sums(flows, formulas, strict=False).collect()}
    for (d, place), row in got.items():
        sides = {}
        for role in ("num", "den"):
            parts = [(value.get((d, t[3])), t[4]) for t in TERMS if t[1] == place and t[2] == role]
            sides[role] = None if any(v is None for v, _ in parts) else sum(v * w for v, w in parts)
            if role == "num":
                here = [v * w for v, w in parts if v is not None]
                assert loose[d, place] == (sum(here) if here else None)
        assert (row["num"], row["den"]) == (sides["num"], sides["den"])
        n, den = sides["num"], sides["den"]
        want = 0.0 if n is None or den is None else (min(n / den, 1) if den else (1.0 if n else 0.0))
        assert row["value"] == want
    # Every (month, place) with at least one node has a row.
    assert set(got) == {(d, t[1]) for _, d, n, _ in data for t in TERMS if t[3] == n}


def test_exceptions_by_place(spark):
    flows = spark.createDataFrame([("s", dt.date(1990, 1, 31), n, v) for n, v in (("x", 4.0), ("y", 2.0), ("z", 1.0))],
                                  "scenario string, date date, node string, flow_cfs double")
    terms = [("m", p, "num", "x") for p in "AB"] + [("m", p, "den", "y") for p in "AB"]
    out = R.formula_ratio(flows, R.formula_frame(spark, terms), M.DIVERTED_CAPPED, {"B": M.DIVERTED_UNCAPPED})
    assert {r["place"]: r["value"] for r in out.collect()} == {"A": 1.0, "B": 2.0}


def test_formula_table_counts_its_terms(spark):
    terms = spark.createDataFrame([("m", "A", "num", "x", 1.0), ("m", "A", "num", "y", 1.0)],
                                  "metric string, place string, role string, node string, weight double")
    flows = spark.createDataFrame([("s", dt.date(1990, 1, 31), "x", 1.0), ("s", dt.date(1990, 2, 28), "x", 1.0),
                                   ("s", dt.date(1990, 2, 28), "y", 2.0)], "scenario string, date date, node string, flow_cfs double")
    out = R.formula_sums(flows, R.with_term_counts(terms)).orderBy("date").collect()
    assert [r["num"] for r in out] == [None, 3.0]


MEMBERS = [("e", "Antelope", "a", "shared"), ("e", "Deer", "d", "shared"), ("e", "Mill", "m", "shared")]


@pytest.mark.parametrize("own,shared,want", [
    ((2.0, 1.0, 1.0), 8.0, (4.0, 2.0, 2.0)),
    ((0.0, 3.0, 1.0), 8.0, (0.0, 6.0, 2.0)),
    ((0.0, 0.0, 0.0), 8.0, (0.0, 0.0, 0.0)),
    ((2.0, None, 1.0), 8.0, (None, None, None)),
    ((0.0, None, 1.0), 8.0, (0.0, None, None)),
    ((2.0, 1.0, 1.0), None, (None, None, None)),
])
def test_apportion(spark, own, shared, want):
    d = dt.date(1990, 1, 31)
    data = [("s", d, n, v) for n, v in zip("adm", own)] + [("s", d, "shared", shared)]
    flows = spark.createDataFrame(data, "scenario string, date date, node string, flow_cfs double")
    got = {r["place"]: r["value"] for r in R.apportion(flows, MEMBERS).collect()}
    assert tuple(got[p] for p in ("Antelope", "Deer", "Mill")) == want


def test_apportioned_parts_sum_to_the_shared_flow(spark):
    rng = random.Random(5)
    data = []
    for y in range(1980, 2000):
        d = dt.date(y, 5, 31)
        data += [("s", d, n, float(rng.randrange(1, 90))) for n in ("a", "d", "m", "shared")]
    flows = spark.createDataFrame(data, "scenario string, date date, node string, flow_cfs double")
    sums = R.apportion(flows, MEMBERS).groupBy("date").agg(F.sum("value").alias("v"), F.max("shared").alias("s"))
    for r in sums.collect():
        assert r["v"] == pytest.approx(r["s"])
