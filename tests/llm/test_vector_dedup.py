from __future__ import annotations

import numpy as np
import pytest

from freshet.llm import vector_dedup
from freshet.llm.queries import op13_vector_dedup
from tests.llm.conftest import DATA

VECTORS = "vec_id long, embedding array<float>, label int, key long, id long, v int, cell int"


def brute(rows, threshold=0.98):
    """rows: (id, vector, label). What near_groups returns, by all pairs."""
    rows = list({(i, None if v is None else tuple(v), g) for i, v, g in rows})

    def vector(v):
        ok = v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
        return np.array(v, np.float32).astype(float) if ok else None

    x = [vector(v) if i is not None and g is not None else None for i, v, g in rows]
    links, root = [0] * len(rows), {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if x[a] is None or x[b] is None or rows[a][2] != rows[b][2] or len(x[a]) != len(x[b]):
                continue
            if x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                root[q] = p
    return sorted((str(i), n, str(find(i)), i == find(i)) for (i, _, _), n in zip(rows, links, strict=True))


def got(df):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in df.collect())


def near(center, count, noise, rng):
    return (center + noise * rng.normal(size=(count, len(center)))).astype(np.float32).tolist()


def planted(dimension=16, groups=40, each=8, lone=300, seed=3, labels=2):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        # About the threshold: some pairs of a group link and some do not.
        rows += near(rng.normal(size=dimension), each, rng.choice([0.05, 0.12, 0.16]), rng)
    rows += rng.normal(size=(lone, dimension)).astype(np.float32).tolist()
    rows += rows[:20]
    order = rng.permutation(len(rows))
    return [(int(i), rows[k], int(k) % labels) for i, k in enumerate(order)]


@pytest.mark.parametrize("data", [DATA, "/root/testdata/sf0.1"])
def test_the_query_against_all_pairs(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(op13_vector_dedup(spark, data)) == brute(rows)


@pytest.mark.parametrize("lot", [16, 1024])
def test_links_across_cells_and_lots(spark, monkeypatch, lot):
    monkeypatch.setattr(vector_dedup, "LOT", lot)
    rows = planted()
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    want = brute(rows)
    assert got(vector_dedup.near_groups(df)) == want and sum(n for _, n, _, _ in want) > 400


def test_low_dimensions_have_links_over_many_borders(spark):
    """On a circle the borders of cells run through the groups."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 0) for i, a in enumerate(rng.uniform(0, 6.28, 500))]
    rows = [(i, np.array(v, np.float32).tolist(), g) for i, v, g in rows]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    assert got(vector_dedup.near_groups(df, 0.999)) == brute(rows, 0.999)


def test_visits_lose_no_pair():
    rng = np.random.default_rng(5)
    x = vector_dedup.unit(rng.normal(size=(1500, 4)))
    distance = np.sqrt(2 - 2 * 0.98)
    own, visits = vector_dedup.cells(x, vector_dedup.centroids(x, 24), distance)
    p, q = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    apart = own[p] != own[q]
    assert apart.sum() > 10 and visits.mean() < 0.5
    assert (visits[p, own[q]] | visits[q, own[p]])[apart].all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [1.0, inf], 0), (6, [], 0), (7, [1.0, 0.0], None), (None, [1.0, 0.0], 0)]
    fine = [(20, [1.0, 0.0], 0), (21, [2.0, 0.0], 0), (22, [1.0, 0.0], 1), (23, [1.0], 0), (24, [3.0], 0), (25, [1.0, 0.0], 0), (25, [1.0, 0.0], 0), (26, [-1e30, 1e29], 0), (27, [-1e-30, 1e-31], 0)]
    rows = [*bad, *fine]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    out = got(vector_dedup.near_groups(df))
    known = {i: (n, c, k) for i, n, c, k in out}
    assert len(out) == len(rows) - 1
    assert all(known[str(i)] == (0, str(i), True) for i, _, _ in bad)
    assert known["20"] == (2, "20", True) and known["21"] == (2, "20", False) and known["25"] == (2, "20", False)
    assert known["22"] == (0, "22", True) and known["24"] == (1, "23", False)
    assert known["26"] == (1, "26", True) and known["27"] == (1, "26", False)


def test_hot_group_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "LOT", 64)
    rng = np.random.default_rng(6)
    rows = [(i, v, 0) for i, v in enumerate(near(np.ones(12), 400, 0.02, rng) + [[2.0] * 12] * 200 + rng.normal(size=(200, 12)).astype(np.float32).tolist())]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    assert got(vector_dedup.near_groups(df)) == brute(rows)
    assert vector_dedup.near_groups(df.limit(0)).count() == 0
