from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from freshet.llm import packing
from freshet.llm.queries import op1_best_fit_packing
from tests.llm.conftest import DATA, ODD_TEXTS, text

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(docs, capacity=4096):
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            cut = np.array(ids[at : at + capacity], "<u4")
            yield doc_id, k, at, len(cut), zlib.crc32(cut.tobytes())


def check_places(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_against_the_library(spark):
    rows = op1_best_fit_packing(spark, DATA).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted(brute_pieces(docs))
    total = sum(r["length"] for r in rows)
    assert check_places(rows, 4096) <= -(-total // 4096) + 2


def test_odd_texts_small_capacity_and_repeated_rows(make_docs):
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b"), (3, None), (4, "x"), (4, "x")]
    rows = packing.pack(make_docs(docs), PATH, capacity=16).collect()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    got = sorted((key((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows))
    assert got == sorted(key(p) for p in brute_pieces(docs, 16))
    check_places(rows, 16)


def test_empty_table(make_docs):
    out = packing.pack(make_docs([]), PATH)
    assert out.count() == 0 and "sequence_id" in out.columns


def test_words_with_marks_and_long_words():
    known = packing.WordIds(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for t in [*ODD_TEXTS[1:], "a" * 5000, "Ab,Cd. e!!f ???x x??? 'tis 's", text(400, 1, "abcdeéß'.,!")]:
        assert np.frombuffer(known.encode([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:40]


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(513, dtype=object)
    for n in rng.integers(1, 513, 60):
        counts[n] = int(rng.integers(1, 10 ** int(rng.integers(1, 8))))
    runs = packing.plan(counts, 512)
    found = np.zeros(513, dtype=object)
    for times, lengths in runs:
        assert times > 0 and sum(lengths) <= 512
        for n in lengths:
            found[n] += times
    assert (found == counts).all()
    # No more than best fit decreasing alone needs: nothing is large, so nothing is grouped.
    assert sum(t for t, _ in runs) <= sum(t for t, _ in packing._plan(counts, 512, 1, 1.0))


def test_equal_groups_and_configurations():
    counts = np.zeros(101, dtype=object)
    counts[[30, 40, 50, 60]] = [10, 10, 10, 10]
    assert packing.linear_groups(counts, 25, 2) == [[(60, 10), (50, 10)], [(40, 10), (30, 10)]]
    assert packing.linear_groups(counts, 25, 3) == [[(60, 10), (50, 4)], [(50, 6), (40, 8)], [(40, 2), (30, 10)]]
    counts[60] = 30  # two groups of the same length are one
    assert packing.linear_groups(counts, 25, 4)[0] == [(60, 30)]
    found = packing.configurations([60, 40], [20, 20], 100)
    assert sum(n for n, _ in found) == 20  # one of each


def test_places_cover_ranks():
    at = packing.places([(2, (5, 3)), (3, (3, 3))])
    assert at["length"].tolist() == [3, 3, 3, 5]
    assert at["rank"].tolist() == [0, 2, 5, 0]
    assert at["sequence"].tolist() == [0, 2, 2, 0] and at["offset"].tolist() == [5, 0, 3, 0]
