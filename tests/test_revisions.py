"""Editions, digests and the summary of a line fit."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.functions.distribution import student_p
from freshet.operators import digest
from freshet.operators.stats import fit_summary
from freshet.operators.formula import formula_frame
from freshet.plans import revision
from freshet.sources import editions, store


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "scenario string, x int")


def test_a_run_that_fails_half_way_changes_nothing(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    assert editions.places(spark, root) is None
    editions.publish(spark, {"a": frame(spark, ("s", 1), ("t", 2)), "b": frame(spark, ("s", 3))}, root)
    with pytest.raises(Exception, match="no b"):
        with editions.draft(spark, root) as d:
            d.write("a", frame(spark, ("s", 9)))
            d.write("b", frame(spark, ("s", 9)).withColumn("x", F.raise_error(F.lit("no b")).cast("int")))
    assert editions.numbers(spark, root) == [1]
    assert rows(store.lookup(spark, root, "a"), "scenario", "x") == [("s", 1), ("t", 2)]
    assert rows(editions.lookup(spark, root, "b"), "scenario", "x") == [("s", 3)]


def test_an_edition_carries_what_it_does_not_replace(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    editions.publish(spark, {"a": frame(spark, ("s", 1), ("x y=z", 2)), "b": frame(spark, ("s", 3))}, root)
    editions.publish(spark, {"a": frame(spark, ("s", 4), ("new", 5))}, root)
    assert rows(editions.lookup(spark, root, "a"), "scenario", "x") == [("new", 5), ("s", 4), ("x y=z", 2)]
    assert rows(editions.lookup(spark, root, "a", edition=1), "scenario", "x") == [("s", 1), ("x y=z", 2)]
    assert rows(editions.lookup(spark, root, "b"), "x") == [(3,)]
    one = editions.lookup(spark, root, "a", "x y=z")
    assert rows(one, "x") == [(2,)] and all("/scenario=x " in f or "/scenario=x%20" in f for f in one.inputFiles())
    for dataset, scenario in (("a", "none"), ("c", None)):
        with pytest.raises(KeyError):
            editions.lookup(spark, root, dataset, scenario)
    store.register(spark, root, ["a"])
    assert spark.sql("SELECT sum(x) FROM a").first()[0] == 11


def test_two_writers_both_come_in(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    one, two = editions.Draft(spark, root), editions.Draft(spark, root)
    one.write("a", frame(spark, ("s", 1)))
    two.write("a", frame(spark, ("t", 2)))
    assert (one.publish(), two.publish()) == (1, 2)
    assert rows(editions.lookup(spark, root, "a"), "scenario", "x") == [("s", 1), ("t", 2)]
    assert not editions.Folder(spark, root).write_new("_editions/00000002", "{}")
    assert [n for n in editions.Folder(spark, root).names("_editions") if "tmp" in n] == []


def test_old_editions_expire(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    for x in range(4):
        editions.publish(spark, {"a": frame(spark, ("s", x)), **({"b": frame(spark, ("s", 7))} if x == 0 else {})}, root)
    gone = editions.expire(spark, root, keep=1)
    assert len(gone) == 2 and editions.numbers(spark, root) == [4]
    assert rows(editions.lookup(spark, root, "a"), "x") == [(3,)] and rows(editions.lookup(spark, root, "b"), "x") == [(7,)]


KEYS, VALUES = ["k", "j"], ["v", "w"]
SCHEMA = "k string, j int, v double, w string"


def test_digest_diff_against_all_rows(spark, rows):
    rng = random.Random(1)
    left = {(rng.choice(["a", "b", None]), i): (rng.choice([None, float("nan"), 0.0, 1.5]), rng.choice(["x", None])) for i in range(300)}
    right = dict(left)
    for key in rng.sample(sorted(left, key=str), 12):
        right[key] = (2.5, left[key][1]) if rng.random() < 0.5 else (left[key][1] and 1.0, None)
    for key in rng.sample(sorted(left, key=str), 5):
        del right[key]
    right |= {("new", i): (None, "x") for i in range(4)}
    make = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], SCHEMA)
    text = lambda d, k: str(d.get(k))
    want = {k: "added" if k not in left else "removed" if k not in right else "changed" for k in {*left, *right} if text(left, k) != text(right, k)}
    for buckets in (1, 64, 4096):
        got = digest.digest_diff(make(left), make(right), KEYS, VALUES, buckets).collect()
        assert {(r["k"], r["j"]): r["change"] for r in got} == want and len(got) == len(want)
    assert got[0].asDict().keys() == {"k", "j", "change", "left_v", "left_w", "right_v", "right_w"}


def test_equal_publications_are_told_without_a_join(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    out = digest.digest_diff(df, df.repartition(5, "v"), ["k"], ["v"])
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_digests_of_parts_add_up(spark, rows):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    parts = digest.digests(df.filter("k < 700"), ["k"], ["v"], 256).unionByName(digest.digests(df.filter("k >= 700"), ["k"], ["v"], 256))
    whole = digest.digests(df, ["k"], ["v"], 256)
    assert rows(digest.branches(parts, 1)) == rows(digest.branches(whole, 1))
    assert digest.branches(digest.branches(whole)).count() == 1


def test_missing_values_count_by_their_place(spark):
    one = spark.createDataFrame([("a", 1, None, "1.0")], SCHEMA)
    two = spark.createDataFrame([("a", 1, 1.0, None)], SCHEMA)
    assert digest.differing_buckets(one, two, KEYS, VALUES) != []
    twice = one.unionByName(one)
    assert digest.differing_buckets(twice, one.limit(0), KEYS, VALUES) != []


def by_integration(t, df):
    u = np.linspace(0, abs(t), 200_001)
    log = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    y = np.exp(log - (df + 1) / 2 * np.log1p(u * u / df))
    return 1 - 2 * float(np.sum((y[1:] + y[:-1]) / 2) * (u[1] - u[0]))


def test_p_values(spark):
    cases = [(t, float(df)) for t in (0.001, 0.5, 1.0, 2.5, -3.0) for df in (1, 2, 3, 10, 77, 5000, 1_000_000)]
    got = spark.createDataFrame(cases, "t double, df double").select(student_p(F.col("t"), F.col("df"))).collect()
    for (t, df), r in zip(cases, got, strict=True):
        assert r[0] == pytest.approx(by_integration(t, df), abs=1e-8), (t, df)
    odd = [(0.0, 5.0), (float("inf"), 5.0), (None, 5.0), (1.0, 0.0), (float("nan"), 4.0), (40.0, 30.0)]
    got = [r[0] for r in spark.createDataFrame(odd, "t double, df double").select(student_p(F.col("t"), F.col("df"))).collect()]
    assert got[:5] == [1.0, 0.0, None, None, None] and 0 < got[5] < 1e-25


def test_steps_of_the_fraction_do_not_evaluate_its_arguments(spark):
    frame = spark.createDataFrame([(0.5, 7.0)], "t double, df double").select(student_p(F.col("t"), F.col("df")))
    steps = frame._jdf.queryExecution().analyzed().toString().split("aggregate(")[1:]
    assert steps and all("t#" not in s.split("lambdafunction(")[1] for s in steps)


def test_summary_of_an_ill_conditioned_fit(spark):
    """Values that lie far from zero, against a fit of centred values."""
    rng = np.random.default_rng(2)
    x = 1e8 + rng.uniform(0, 10, 200)
    y = 3e5 + 2 * (x - 1e8) + rng.normal(0, 1, 200)
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(y, x)] + [("g", None, 1.0), ("two", 1.0, 1.0), ("two", 2.0, 3.0), ("flat", 1.0, 5.0), ("flat", 2.0, 5.0), ("exact", 1.0, 0.0), ("exact", 2.0, 1.0), ("exact", 3.0, 2.0)], "k string, y double, x double")
    got = {r["k"]: r for r in fit_summary(df, F.col("y"), F.col("x"), ["k"]).collect()}
    u, v = x - x.mean(), y - y.mean()
    slope = (u @ v) / (u @ u)
    error = math.sqrt(((v - slope * u) ** 2).sum() / 198)
    g = got["g"]
    assert g["n"] == 200 and g["slope"] == pytest.approx(slope, rel=1e-7) and g["residual_error"] == pytest.approx(error, rel=1e-7)
    assert g["slope_error"] == pytest.approx(error / math.sqrt(u @ u), rel=1e-7)
    assert g["slope_p"] == pytest.approx(by_integration(g["slope_t"], 198), abs=1e-9)
    assert g["intercept_t"] == pytest.approx(g["intercept"] / g["intercept_error"]) and g["f"] == pytest.approx(g["slope_t"] ** 2)
    assert got["two"]["slope"] == 0.5 and got["two"]["slope_p"] is None and got["two"]["residual_error"] is None
    assert got["flat"]["slope"] is None and got["exact"]["slope"] == 1.0 and got["exact"]["slope_p"] == 0.0 and got["exact"]["r2"] == 1.0


MONTHS = "scenario string, year int, month int, node string, flow_cfs double"
TERMS = [("value", "P", "num", "N1"), ("value", "P", "num", "N2"), ("value", "Q", "num", "N3"), ("value", "R", "num", "N2"), ("value", "R", "num", "N3")]


def months(spark, change=None):
    out = []
    for s in "ab":
        for y in (1990, 1991, 1992):
            for m in (1, 2):
                for n in ("N1", "N2", "N3"):
                    v = float(y % 10 * 100 + m * 10 + int(n[1]))
                    v = change(s, y, m, n, v) if change else v
                    if v != "gone":
                        out.append((s, y, m, n, v))
    return spark.createDataFrame(out, MONTHS)


@pytest.mark.parametrize("kind", ["value", "missing", "gone", "same"])
def test_only_changed_cells_are_computed_and_only_their_partitions_read(spark, tmp_path, rows, monkeypatch, kind):
    root, by = str(tmp_path / "out"), ("scenario", "year")
    terms = formula_frame(spark, TERMS)
    with editions.draft(spark, root) as d:
        d.write("inputs", months(spark), by)
    with editions.draft(spark, root) as d:
        d.write("cube", revision.cells(editions.lookup(spark, root, "inputs"), terms), by)

    def change(s, y, m, n, v):
        hit = (s, y, m, n) == ("a", 1991, 2, "N1")
        return {"value": v + 1, "missing": None, "gone": "gone", "same": v}[kind] if hit else v

    new = months(spark, change).filter("scenario = 'a' and year = 1991")
    with editions.draft(spark, root) as d:
        d.write("inputs", new, by)
    computed = []
    plain = revision.cells
    monkeypatch.setattr(revision, "cells", lambda inputs, terms: computed.append(inputs) or plain(inputs, terms))
    revision.revise_slice(spark, root, "cube", "inputs", 2, TERMS)
    cube = editions.lookup(spark, root, "cube")
    want = plain(months(spark, change), terms)
    assert rows(cube, "scenario", "year", "month", "place", "value") == rows(want, "scenario", "year", "month", "place", "value")
    now = editions.places(spark, root)["cube"]
    before = editions.places(spark, root, 2)["cube"]
    assert [p for p in now if now[p] != before[p]] == ([] if kind == "same" else ["scenario=a/year=1991"])
    for inputs in computed:
        assert {(r["month"], r["node"]) for r in inputs.collect()} <= {(2, "N1"), (2, "N2")}
        assert all("scenario=a/year=1991" in f for f in inputs.inputFiles() if "/inputs/" in f)


def test_cells_and_partitions_that_lose_their_inputs_go(spark, tmp_path, rows):
    root, by = str(tmp_path / "out"), ("scenario", "year")
    with editions.draft(spark, root) as d:
        d.write("inputs", months(spark), by)
        d.write("cube", revision.cells(months(spark), formula_frame(spark, TERMS)), by)
    with editions.draft(spark, root) as d:
        d.drop("inputs", ["scenario=a/year=1990"])
        d.write("inputs", months(spark).filter("scenario = 'b' and year = 1992 and month = 1 and node <> 'N3'"), by)
    changed = revision.revise_slice(spark, root, "cube", "inputs", 1, TERMS)
    assert changed == ["scenario=a/year=1990", "scenario=b/year=1992"]
    left = months(spark).filter("not (scenario = 'a' and year = 1990) and not (scenario = 'b' and year = 1992 and (month = 2 or node = 'N3'))")
    want = revision.cells(left, formula_frame(spark, TERMS))
    columns = ["scenario", "year", "month", "place", "value"]
    assert rows(editions.lookup(spark, root, "cube"), *columns) == rows(want, *columns)
    assert "scenario=a/year=1990" not in editions.places(spark, root)["cube"]


def test_nothing_to_revise(spark, tmp_path):
    root, by = str(tmp_path / "out"), ("scenario", "year")
    with editions.draft(spark, root) as d:
        d.write("inputs", months(spark), by)
        d.write("cube", revision.cells(months(spark), formula_frame(spark, TERMS)), by)
    assert revision.revise_slice(spark, root, "cube", "inputs", 1, TERMS) == []
    assert editions.numbers(spark, root) == [1]
