from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import neighbours
from freshet.llm.queries import op2_nearest_neighbours
from tests.llm.conftest import DATA

VECTORS = "vec_id long, embedding array<float>, label int, bucket long, id long"


def brute(rows, queries, k):
    out = {}
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in queries:
        scored = [(-round(float(x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i])), 9), i) for i in x if i != q]
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("data", [DATA, "/root/testdata/sf0.1"])
def test_recall_and_scores_of_the_query(spark, data):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = op2_nearest_neighbours(spark, data).collect()
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    vectors = {i: np.array(v, float) for i, v in rows}
    hits = sum(r["vec_id"] in want[r["query_id"]] for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q in want:
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        for r in own:
            a, b = vectors[q], vectors[r["vec_id"]]
            assert r["score"] == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [2.0, 0.0]), (3, [3.0, 0.0]), (9, [-1.0, 0.0])]
    bad = [(1, None), (2, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (8, [1.0]), (None, [1.0, 0.0]), (11, [])]
    rows = [(i, v, 0, 1, 2) for i, v in [*good, *bad, (7, [2.0, 0.0])]]
    out = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("id") % 50 == 0, k=5)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [3, 7, 50, 9], 50: [0, 3, 7, 9]}


def test_hot_vector_keeps_the_smallest_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 else rng.normal(size=4).tolist(), 0, 1, 2) for i in range(600)]
    got = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("id") == 100, k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 4, 5, 7]


def test_empty_table(spark):
    assert neighbours.search(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_perturbations_come_in_order():
    place, width = np.array([0.1, 0.9, 1.6]), 2.0
    steps = list(neighbours.perturbations(place, width, 26))
    cost = [sum((width - place[f]) ** 2 if up else place[f] ** 2 for f, up in s) for s in steps]
    assert cost == sorted(cost) and len({tuple(sorted(s)) for s in steps}) == len(steps) == 26  # 3 ** 3 - 1
    assert steps[0] == [(0, False)]


def test_large_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LOT", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), 0, 1, 2) for i in range(400)]
    got = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("id") % 50 == 0, k=5, probes=256).collect()
    want = brute([r[:2] for r in rows], range(0, 400, 50), 5)
    assert sum(r["vec_id"] in want[r["query_id"]] for r in got) >= 0.95 * 40


def test_without_the_wanted_recall_all_vectors_are_compared(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "RECALL", 1.1)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=32).tolist(), 0, 1, 2) for i in range(300)]
    assert neighbours.fitted(np.array([r[1] for r in rows]), 5, 1.1) is None
    got = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("id") % 50 == 0, k=5).collect()
    want = brute([r[:2] for r in rows], range(0, 300, 50), 5)
    assert {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want} == want


def test_the_fit_takes_the_cheapest_setting():
    rng = np.random.default_rng(7)
    near = np.repeat(rng.normal(size=(80, 32)), 10, axis=0) + 0.01 * rng.normal(size=(800, 32))
    x = neighbours.unit(near[rng.permutation(800)])
    hashes, count = neighbours.fitted(x, 5, 0.97)
    met = (neighbours.visits(hashes, x, 100) < count).mean()
    assert met < 0.25  # groups of ten are found among a few vectors
    first = neighbours.visits(hashes, x[:50], 20)
    own, asked = hashes.buckets(x[:50]), hashes.probes(x[:20], neighbours.PROBES[-1])
    for q in range(20):
        for r in range(50):
            places = [int(np.flatnonzero(asked[q, t] == own[r, t])[0]) for t in range(hashes.tables) if own[r, t] in asked[q, t]]
            assert first[q, r] == min(places, default=neighbours.PROBES[-1])


def test_groups_of_buckets(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), 0, 1, 2) for i in range(500)]
    table = spark.createDataFrame(rows, VECTORS)
    want = sorted(map(tuple, neighbours.search(table, F.col("id") % 50 == 0, k=5, probes=32).collect()))
    monkeypatch.setattr(neighbours, "GROUP_NUMBERS", 200)
    assert sorted(map(tuple, neighbours.search(table, F.col("id") % 50 == 0, k=5, probes=32).collect())) == want
