"""Exact medians, entries before, networks: groups of any size."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators import intervals, order_stats, sequence
from freshet.operators.intervals import PER_LOT, _looked, _lots, interval_join
from freshet.operators.sequence import accumulate_network, previous_entry
from freshet.operators.skew import spread_join

NAN, INF = float("nan"), float("inf")


def text(v):
    return None if v is None else str(v)


def check_medians(spark, data, strict=False, **sizes):
    df = spark.createDataFrame([(k, v) for k, values in data.items() for v in values], "k string, v double")
    got = {r["k"]: (r["n"], text(r["median"])) for r in order_stats.exact_median(df, ["k"], "v", strict, **sizes).collect()}
    want = df.groupBy("k").agg(F.count("v").alias("n"), F.median("v").alias("m"), F.count("*").alias("all")).collect()
    assert got == {r["k"]: (r["n"], text(r["m"]) if r["n"] == r["all"] or not strict else None) for r in want}


@pytest.mark.parametrize("few", [5, 4096])
def test_medians_of_hot_odd_and_wide_groups(spark, few):
    rng = random.Random(few)
    data = {
        "even": [float(rng.randrange(50)) for _ in range(500)],
        "odd": [rng.gauss(0, 1) for _ in range(501)],
        "magnitudes": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(300)],
        "ends": [-1.7e308, 1.7e308, 5e-324, 0.0, -0.0, 1.0],
        "close": [1e10 + i * 2e-6 for i in range(200)],
        "equal": [3.5] * 400,
        "two": [1.0] * 100 + [2.0] * 100,
        "one": [7.0],
        "nulls": [None, None],
        "some": [None, 1.0, 2.0],
        "special": [NAN, INF, -INF, 1.0, 2.0, INF, NAN],
        "low": [-INF, -INF, 1.0, 2.0],
        "none": [NAN, NAN, -INF],
        None: [1.0, 5.0, 9.0],
    }
    check_medians(spark, data, ranges=256, few=few)


def test_strict_medians_and_empty_tables(spark):
    check_medians(spark, {"a": [1.0, None], "b": [1.0, 4.0]}, strict=True)
    df = spark.createDataFrame([], "k string, v double")
    assert order_stats.exact_median(df, ["k"], "v").count() == 0
    assert order_stats.exact_median(spark.createDataFrame([("a", 2.0)], "k string, v double"), [], "v").collect()[0]["median"] == 2.0


def test_no_task_sorts_more_than_few_values(spark):
    """Only brackets reach a list of values: the plan's last reading is bounded by their sizes."""
    df = spark.range(20000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 20000).cast("double").alias("v"))
    out = order_stats.exact_median(df, ["k"], "v", ranges=16, few=100)
    assert out.collect()[0]["median"] == 9999.5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "percentile" not in plan.lower()


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_entries_before_over_the_borders_of_ranges(spark, rows, ranges):
    rng = random.Random(ranges)
    data = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 5}", rng.randrange(40) if i % 13 else None, i, f"v{i}") for i in range(600)]
    log = spark.createDataFrame(data, "k string, t int, id int, v string")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows(log.select("id", F.lag("v").over(w), F.lag("t").over(w)))
    got = previous_entry(log, ["k"], ["t", "id"], ["v", "t"], ranges=ranges)
    assert got.columns == ["k", "t", "id", "v", "previous"]
    assert rows(got.select("id", "previous.v", "previous.t")) == want


def test_equal_entries_are_refused(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, t int, v string")
    with pytest.raises(Exception, match="several rows"):
        previous_entry(log, ["k"], ["t"], ["v"]).collect()
    assert previous_entry(log.limit(0), ["k"], ["t"], ["v"]).count() == 0


def brute(flows, parent):
    out = {}
    for s, n, _ in flows:
        total, missing = 0.0, False
        for s2, m, v in flows:
            at = m
            while at is not None and at != n:
                at = parent.get(at)
            if at == n and s2 == s:
                missing |= v is None
                total += v or 0.0
        out[s, n] = None if missing else total
    return sorted((s, n, v) for (s, n), v in out.items())


def test_accumulation_over_chains_trees_and_gaps(spark):
    rng = random.Random(1)
    parent = {i: i - 1 for i in range(1, 70)} | {100 + i: rng.choice([0, 30, 69]) for i in range(60)} | {200: None, 0: None}
    # Nodes without a row, and nodes that the network does not have.
    flows = [(s, n, float(rng.randrange(9)) if rng.random() < 0.98 else None) for s in "ab" for n in [*parent, 500] if rng.random() < 0.8]
    df = spark.createDataFrame(flows, "scenario string, node int, flow_cfs double")
    edges = spark.createDataFrame(list(parent.items()), "node int, parent int")
    got = accumulate_network(df, edges, ["scenario"]).collect()
    key = lambda r: (r[0], r[1])
    assert sorted(((r["scenario"], r["node"], r["accumulated"]) for r in got), key=key) == sorted(brute(flows, parent), key=key)


def test_networks_that_are_none(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "scenario string, node int, flow_cfs double")
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "node int, parent int")
    with pytest.raises(ValueError, match="back to itself"):
        accumulate_network(df, ring, ["scenario"])
    with pytest.raises(Exception, match="several rows"):
        accumulate_network(df, spark.createDataFrame([(1, 2), (1, 3)], "node int, parent int"), ["scenario"]).collect()
    none = spark.createDataFrame([], "node int, parent int")
    assert [r["accumulated"] for r in accumulate_network(df, none, ["scenario"]).collect()] == [1.0]
    assert math.isclose(accumulate_network(df, ring.limit(0), ["scenario"]).first()["accumulated"], 1.0)


def test_intervals_of_all_lengths(spark, rows):
    rng = random.Random(3)
    start = dt.date(1900, 1, 1)
    day = lambda n: start + dt.timedelta(n)
    spans = [(rng.choice(["a", "b", None]), f"i{i}", rng.randrange(60000), rng.choice([0, 1, 7, 8, 9, 30, 400, 9000, 50000])) for i in range(150)]
    intervals = [(k, n, day(a), day(a + b)) for k, n, a, b in spans] + [("a", "none", None, day(5)), ("a", "back", day(9), day(5)), ("a", "long", dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    dated = [(rng.choice(["a", "a", "b", "c", None]), i, day(rng.randrange(-5, 61000))) for i in range(400)] + [("a", -1, None)]
    left = spark.createDataFrame(dated, "k string, id int, date date")
    right = spark.createDataFrame(intervals, "k string, name string, first date, last date")
    want = sorted((i, n) for k, i, d in dated for k2, n, a, b in intervals if k is not None and k == k2 and d and a and a <= d <= b)
    joined = interval_join(left, right, "date", "first", "last", ["k"])
    assert joined.columns == ["k", "id", "date", "name", "first", "last"]
    assert sorted((r["id"], r["name"]) for r in joined.collect()) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(left, right.limit(0), "date", "first", "last", ["k"]).count() == 0


def test_rows_before_and_after_all_intervals_are_not_shuffled(spark):
    binned = spark.createDataFrame([(0, 100), (0, 110), (4, 6)], "__level int, __bin long")
    dated = spark.createDataFrame([(d,) for d in (0, 700, 768, 799, 800, 850, 888, 896, 9999)], "day int").select(F.date_from_unix_date("day").alias("date"))
    got = sorted((r["day"], r["__level"], r["__bin"]) for r in _looked(dated, binned, "date").withColumn("day", F.unix_date("date")).collect())
    assert got == [(768, 4, 6), (799, 4, 6), (800, 0, 100), (800, 4, 6), (850, 0, 106), (850, 4, 6), (888, 4, 6)]


def test_lots_are_whole_and_bounded(spark, rows):
    """Copies, nulls and days of one row or of many."""
    data = [(i % 2, dt.datetime(2020, 1, 1 + (0 if i < 900 else i % 9), i % 24), None if i % 7 == 0 else i // 3) for i in range(1000)]
    frame = spark.createDataFrame(data, "k int, at timestamp, v int")
    lots = _lots(frame, ["k"], "at", 2).select("k", "__day", "__lot", "__rows").collect()
    assert sorted(map(str, (tuple(r) for lot in lots for r in lot["__rows"]))) == sorted(map(str, data))
    assert all(r["k"] == lot["k"] and r["at"].date() == lot["__day"] for lot in lots for r in lot["__rows"])
    assert len({lot["__lot"] for lot in lots}) > 1 and max(len(lot["__rows"]) for lot in lots) <= PER_LOT
    assert len(lots) < 60  # 900 rows of two keys and one day, 100 of eighteen groups


def test_intervals_of_many_rows_a_day(spark, tmp_path, monkeypatch):
    """Each row of a day meets the same intervals: rows are looked up, and intervals written, once a lot and not once a row."""
    looked = []

    def counted(rows, *others, **named):
        looked.append(rows.count())
        return spread_join(rows, *others, **named)

    monkeypatch.setattr(intervals, "spread_join", counted)
    n_rows, n_spans, day = 80, 25_000, F.lit(dt.date(2020, 5, 17))
    left = spark.range(n_rows).select(F.lit(1).alias("k"), day.alias("date"), "id")
    number = F.col("id").cast("int")
    right = spark.range(n_spans).select(
        F.lit(1).alias("k"), (F.col("id") * 7919 % 1_000_003).alias("n"), F.date_sub(day, number % 40).alias("first"), F.date_add(day, number % 37).alias("last")
    )
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        interval_join(left, right, "date", "first", "last", ["k"]).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.agg(F.count("*"), F.countDistinct("id", "n")).first() == (n_rows * n_spans, n_rows * n_spans)
    # Eight lots, five levels.
    assert looked[0] <= 40
    written = sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
    assert written < 0.75 * n_rows * n_spans, written


def test_intervals_without_keys_and_with_keys_of_any_kind(spark):
    dated = spark.createDataFrame([(dt.datetime(2020, 1, 2, 5),), (dt.datetime(2020, 1, 2, 5),), (dt.datetime(2021, 1, 1),), (None,)], "at timestamp")
    spans = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 2), "a")], "first date, last date, n string")
    got = interval_join(dated, spans, "at", "first", "last").collect()
    assert [tuple(r) for r in got] == [(dt.datetime(2020, 1, 2, 5), dt.date(2020, 1, 1), dt.date(2020, 1, 2), "a")] * 2
    keyed = dated.crossJoin(spark.createDataFrame([(NAN,), (-0.0,), (None,), (2.0,)], "k double"))
    spans = spans.crossJoin(spark.createDataFrame([(NAN,), (0.0,), (None,), (3.0,)], "k double"))
    assert sorted(str(r["k"]) for r in interval_join(keyed, spans, "at", "first", "last", ["k"]).collect()) == ["-0.0", "-0.0", "nan", "nan"]


def test_steps_of_a_long_way_move_a_few_times_the_flows(spark, monkeypatch):
    moved, kept = [], sequence.kept

    def counted(df):
        out = kept(df)
        if "sum" in out.columns:
            moved.append(out.count())
        return out

    monkeypatch.setattr(sequence, "kept", counted)
    n = 300
    flows = spark.range(n).select(F.col("id").alias("node"), F.lit(1.0).alias("flow_cfs"))
    edges = spark.range(1, n).select(F.col("id").alias("node"), (F.col("id") - 1).alias("parent"))
    got = accumulate_network(flows, edges, []).collect()
    assert {r["node"]: r["accumulated"] for r in got} == {i: float(n - i) for i in range(n)}
    assert sum(moved) <= 4 * n
