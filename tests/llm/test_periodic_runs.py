from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from freshet.llm import periodic_runs
from freshet.llm.queries import op12_periodic_runs, with_periodic_tails
from tests.llm.conftest import DATA, ODD_TEXTS

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(w, least=6, repeats=4):
    """Runs by definition: each period's maximal stretches, where no smaller period has them."""
    seen, out = set(), []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            # Words i to j + q - 1 have period q.
            if j > i and j - i + q >= max(least, repeats * q) and (i, j + q) not in seen:
                out.append((i, j - i + q, q))
            if j > i and j - i + q >= 2 * q:
                seen.add((i, j + q))
            i = j + 1
    return sorted(out)


def test_runs_of_small_alphabets_against_the_definition():
    rng = random.Random(1)
    for size in (1, 2, 2, 3, 4):
        for _ in range(400):
            w = [rng.randrange(size) for _ in range(rng.randint(0, 60))]
            assert periodic_runs.runs(w) == brute(w)


def woven(rng):
    """Random words, with repeated passages and periodic stretches that touch and nest."""
    w = []
    while len(w) < rng.randint(0, 300):
        base = [rng.randrange(30) for _ in range(rng.randint(1, 20))]
        if rng.random() < 0.3 and len(base) > 3:
            base = base[:2] * 5 + base
        w += (base * 9)[: int(len(base) * rng.choice([1, 1, 2.5, 3.9, 4, 4.6, 8]))]
        if rng.random() < 0.3:
            w += w[: rng.randint(1, 60)]
    return w


def test_stretches_hold_all_runs_and_nothing_is_lost_by_them():
    rng = random.Random(2)
    texts = [woven(rng) for _ in range(400)]
    found, words = periodic_runs._of_texts([" ".join(map(str, w)).encode() for w in texts])
    assert [len(w) for w in words] == [len(w) for w in texts]
    assert found == [brute(w) for w in texts] and sum(map(len, found)) > 300


def test_one_word_and_fibonacci_words_are_not_quadratic():
    assert periodic_runs.runs([7] * 20000) == [(0, 20000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic_runs.runs(b, 2, 2) == brute(b, 2, 2)


def test_few_words_of_plain_text_reach_an_automaton():
    rng = np.random.default_rng(3)
    words = rng.zipf(1.3, 50000) % 2000
    places = periodic_runs.candidates(words, np.zeros(len(words), np.int64))
    assert sum(b - a for a, b in places) < 0.05 * len(words)


def want(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    drop = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for i, x in enumerate(w) if i not in drop))]
    return (doc_id, len(runs), *first, *digest)


def test_the_query_against_the_definition(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, DATA).collect())
    assert got == sorted(want(r["doc_id"], r["text"]) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_texts_and_columns(spark, make_docs, tmp_path):
    texts = [*ODD_TEXTS, "a a a a a a", "a\x0ba\x0ca\ra\na\ta", " x " * 5, "a\x1ca a\x1ca " * 9, None]
    rows = [(k if k % 7 else None, t) for k, t in enumerate(texts)] * 2
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()), key=key)
    assert got == sorted((want(*r) for r in rows), key=key)


def test_general_interface(spark, make_docs):
    docs = make_docs([(1, "so on on on on on on and"), (2, "")])
    rows = {r["doc_id"]: r for r in periodic_runs.with_runs(docs, ["doc_id", "lang", "key", "score"]).collect()}
    assert [tuple(r) for r in rows[1]["runs"]] == [(1, 6, 1)] and rows[1]["collapsed"] == "so on and" and rows[1]["key"] == 5
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == "" and rows[2]["n_words"] == 0
    assert periodic_runs.with_runs(docs.limit(0), ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="runs"):
        periodic_runs.with_runs(docs.withColumn("runs", docs["key"]), ["runs"])


def test_long_text_in_pieces(spark, make_docs):
    words = [f"w{i % 977}{'x' * (i % 5)}" for i in range(400_000)]
    (row,) = periodic_runs.with_runs(make_docs([(1, " ".join(words))]), ["doc_id"]).collect()
    assert row["n_words"] == len(words) and [tuple(r) for r in row["runs"]] == [(0, len(words), 4885)]
    assert row["collapsed"] == " ".join(words[:4885])


def test_tails_only_where_the_hash_says(spark, make_docs):
    docs = make_docs([(i, "a b c d e f g h i j") for i in range(60)])
    changed = [r["doc_id"] for r in with_periodic_tails(docs).filter("text <> 'a b c d e f g h i j'").collect()]
    assert changed and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)
