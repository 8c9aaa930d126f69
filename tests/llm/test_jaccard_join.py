from __future__ import annotations

import random
import re

import numpy as np
import pytest

from freshet.llm import jaccard_join
from freshet.llm.components import components
from freshet.llm.queries import op8_jaccard_join
from tests.llm.conftest import DATA, ODD_TEXTS, text, words


def sets_of(docs):
    out = []
    for _, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(docs, percent=75):
    """(doc_id, size, component) per row, and the links between different sets."""
    sets = sets_of(docs)
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = set()
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
                if sets[i] != sets[j]:
                    links.add(frozenset((sets[i], sets[j])))
    out = []
    for i in range(len(docs)):
        group = [docs[j][0] for j in range(len(docs)) if find(j) == find(i)]
        out.append((docs[i][0], len(sets[i]), min(group) if sets[i] else docs[i][0]))
    return sorted(out), links


def edited(base, seed, edits):
    rng = random.Random(seed)
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def cases(seed):
    """Copies, near copies around the threshold, a shared passage, short texts."""
    rng = random.Random(seed)
    docs, passage = [], words(40, 999)
    for g in range(12):
        base = words(rng.choice([3, 5, 8, 20, 60, 150]), 100 * seed + g)
        docs += [edited(base, 7 * g + k, rng.choice([0, 0, 1, 2, 4])) for k in range(rng.choice([1, 2, 5, 20]))]
    docs += [" ".join(words(60, 5000 + seed * 100 + k) + passage) for k in range(30)]
    docs += [" ".join(passage + words(rng.randint(0, 10), 7000 + k)) for k in range(20)]
    rng.shuffle(docs)
    return [(k * 3 + 1, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize(("seed", "many", "percent"), [(1, 12, 75), (2, 3, 75), (3, 2, 60), (4, 2, 90)])
def test_components_and_links_against_all_pairs(make_docs, seed, many, percent):
    docs = cases(seed)
    want, links = brute(docs, percent)
    rows = jaccard_join.jaccard_join(make_docs(docs), percent=percent, many=many).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == want
    pairs, members = jaccard_join.jaccard_links(make_docs(docs), percent=percent, many=many)
    by_key = {r["key"]: r["doc_id"] for r in members.collect()}
    sets = dict(zip([i for i, _ in docs], sets_of(docs), strict=True))
    found = [frozenset((sets[by_key[r["a"]]], sets[by_key[r["b"]]])) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == links


def test_query_against_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op8_jaccard_join(spark, DATA).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(docs)[0]


def test_odd_texts(make_docs):
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(50, "X"), (51, "x"), (51, "x"), (60, "word,"), (52, "a b c d"), (53, "A B C D"), (54, "b a c d")]
    rows = jaccard_join.jaccard_join(make_docs([*docs, (None, "x"), (None, None), (None, "of its own here")])).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)
    assert got == brute(docs)[0]
    none = sorted((r["n_shingles"], str(r["component_id"])) for r in rows if r["doc_id"] is None)
    assert none == [(0, "None"), (1, "4"), (1, "None")]
    assert jaccard_join.jaccard_join(make_docs([])).count() == 0


def test_one_id_with_two_texts(make_docs):
    a, b = words(50, 1), words(50, 2)
    docs = [(1, " ".join(a)), (1, " ".join(b)), (2, edited(b, 3, 1)), (3, edited(a, 4, 1)), (4, text(50, 9))]
    rows = jaccard_join.jaccard_join(make_docs(docs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert len(rows) == 5


def test_words_of_long_texts_in_blocks(monkeypatch):
    t = [" ".join(words(3000, 4)), None, "a\tb\x0bc " * 500, "x" * 9000 + " y", text(40, 2)]
    whole = jaccard_join.shingle_sets(t)
    monkeypatch.setattr(jaccard_join, "BLOCK", 700)
    assert all((a == b).all() for a, b in zip(whole, jaccard_join.shingle_sets(t), strict=True))
    assert [len(s) for s in whole] == [len(s) for s in sets_of(list(enumerate(t)))]


def test_similar_sets_agree_or_are_known_to_be_short():
    """The enumeration's promise, for sets just similar enough."""
    rng = np.random.default_rng(5)
    bands = jaccard_join.Bands(75)
    for n in [*range(1, 40), 75, 100, 340, 1000]:
        for _ in range(6):
            differ = int(2 * n * 25 // 175)
            left = int(rng.integers(0, differ + 1))
            both = np.unique(rng.integers(0, 1 << 63, 2 * n + 10).astype(np.uint64))
            common = both[: n - differ // 2]
            a, b = np.sort(np.concatenate([common, both[n : n + left]])), np.sort(np.concatenate([common, both[n + left : n + differ]]))
            if not len(a) or 100 * len(common) < 75 * (len(a) + len(b) - len(common)):
                continue
            found, short = [set(), set()], [False, False]
            for used, band, most, nonempty, who, signature in jaccard_join.signatures([a, b], bands):
                for k in (0, 1):
                    found[k] |= set(signature[who == k].tolist())
                    short[k] |= bool(used[k] and nonempty[k] <= most[k])
            assert found[0] & found[1] or all(short)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for n in (1, 5, 31, 33, 200, 1000):
        x = np.unique(rng.integers(0, 1 << 63, 3 * n).astype(np.uint64))
        for cut in (0, n // 3, n):
            a, b = x[: 2 * n], x[cut : 3 * n]
            apart = jaccard_join.sketch_distance(jaccard_join.sketch(a), jaccard_join.sketch(b))
            assert apart <= len(np.setxor1d(a, b))
            assert jaccard_join.sketch_distance(jaccard_join.sketch(a), jaccard_join.sketch(a)) == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(900, 930)] + [(5, 5), (None, 3), (70, None), (300, 200), (200, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(range(61), 0) | dict.fromkeys([*range(900, 930), 1000], 900) | {200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("many", [12, 2])
def test_near_copies_without_an_id(make_docs, many):
    base = words(80, 1)
    middle = words(80, 7)
    docs = [(k, edited(base, k, 1)) for k in range(3)] + [(9, text(60, 9))]
    # Two documents that only a text without an id links, and texts without ids that link with each other.
    ends = [(20, " ".join(["one"] * 9 + middle)), (21, " ".join(middle + ["two"] * 9)), (None, " ".join(middle))]
    alone = [(None, edited(words(70, 30), k, 1)) for k in range(4)]
    every = [*docs, *ends, *alone, *((None, edited(base, 50 + k, 1)) for k in range(6)), (None, edited(base, 50, 1))]
    # brute() needs an id for each; nulls get the largest ones.
    named = [(k if k is not None else 1000 + i, t) for i, (k, t) in enumerate(every)]
    want = {k: c if c < 1000 else None for k, _, c in brute(named)[0]}
    assert want[21] == 20 and want[9] == 9 and None in want.values()
    rows = jaccard_join.jaccard_join(make_docs(every), many=many).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == {k: c for k, c in want.items() if k < 1000}
    got = sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None)
    assert got == sorted(str(c) for k, c in want.items() if k >= 1000)
