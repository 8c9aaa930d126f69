from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import sharding
from freshet.llm.queries import SHARDS, op4_sharding
from tests.llm.conftest import DATA


def brute_table(shards, slots):
    """Full permutations, claimed in turns."""
    order = sorted(range(len(shards)), key=lambda k: shards[k])
    lists = []
    for k in order:
        offset, skip = sharding.preferences(shards[k], slots)
        lists.append([(offset + j * skip) % slots for j in range(slots)])
        assert sorted(lists[-1]) == list(range(slots))
    table = [None] * slots
    while None in table:
        for k, wishes in zip(order, lists, strict=True):
            free = next((s for s in wishes if table[s] is None), None)
            if free is not None:
                table[free] = k
    return table


def test_table_against_full_permutations():
    shards = [f"s{k}" for k in range(7)]
    assert sharding.lookup_table(shards, 211).tolist() == brute_table(shards, 211)
    assert sharding.lookup_table(["only"], 5).tolist() == [0] * 5


def test_query_places_every_row(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = op4_sharding(spark, DATA).withColumn("want", sharding.slot_of(F.col("doc_id"))).collect()
    table = sharding.lookup_table(SHARDS)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert all(r["slot"] == r["want"] and r["shard"] == SHARDS[table[r["slot"]]] for r in rows)


def test_even_and_little_moved():
    shards = [f"s{k}" for k in range(20)]
    table = sharding.lookup_table(shards, 10_007)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(shards[:-1], 10_007)
    stayed = table != 19
    assert (table[stayed] != fewer[stayed]).mean() < 0.05
    turned = sharding.lookup_table(shards[::-1], 10_007)
    assert (np.array(shards)[table] == np.array(shards[::-1])[turned]).all()


def test_odd_keys_and_clashing_columns(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (None, None), (None, "b"), (2, "")])
    out = sharding.place(docs, F.col("doc_id"), ["x", "y"], 11)
    assert out.columns.count("slot") == 1 and out.columns.count("shard") == 1
    rows = out.collect()
    assert len(rows) == 5
    assert all(len({r["shard"] for r in rows if r["doc_id"] == k}) == 1 for k in (1, 2, None))
    assert {r["shard"] for r in rows} <= {"x", "y"}
    assert sharding.place(make_docs([]), F.col("doc_id"), ["x"], 11).count() == 0


def test_written_shards(spark, make_docs, tmp_path):
    docs = make_docs([(k, "t") for k in range(200)])
    placed = sharding.place(docs.select("doc_id"), F.col("doc_id"), ["x", "y", "z"], 101)
    sharding.write_shards(placed, f"{tmp_path}/out", files=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r["doc_id"], r["shard"]) for r in back.collect()) == sorted((r["doc_id"], r["shard"]) for r in placed.collect())
    assert len(list((tmp_path / "out" / "shard=x").glob("*.parquet"))) <= 2


@pytest.mark.parametrize(("shards", "slots"), [([], 11), (["a", "a"], 11), (["a"], 10), (["a", "b", "c"], 2)])
def test_wrong_tables_are_errors(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)
