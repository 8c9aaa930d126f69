from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import collocations
from tests.llm.conftest import ODD_TEXTS

LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, longest=4, top=2000, share=80):
    """rows: (text, lang)."""
    f: dict[str, Counter] = {}
    for text, lang in rows:
        own = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            for m in range(1, longest + 1):
                own.update(w[i : i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for g, c in own.items() if len(g) == 1)
        asked = {g: c for g, c in own.items() if len(g) > 1 and c >= least}
        gone = {g[i : i + k] for g, c in asked.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if 100 * c >= share * asked[g[i : i + k]]}
        best = []
        for g, a in asked.items():
            if g not in gone:
                score, k = min((2000000 * a // (own[g[:k]] + own[g[k:]]), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def corpus(seed, texts=150, words=12, langs=("en", "de", None)):
    """Frequent words and phrases, some of them only within longer ones; odd gaps and separators."""
    rng = random.Random(seed)
    names = [f"W{i}" if i % 3 else f"é{i}" for i in range(words)]
    phrases = [" ".join(rng.choices(names, k=rng.randint(2, 6))) for _ in range(10)]
    out = []
    for _ in range(texts):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(names) for _ in range(rng.randint(0, 40))]
        out.append(("".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\r\n", ";"]) for p in parts), rng.choice(langs)))
    return out


@pytest.fixture
def small(monkeypatch):
    """Hot prefixes and shared bits on small tables."""
    monkeypatch.setattr(collocations, "HOT", 60)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 7)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_definition(spark, make_docs, seed):
    rows = corpus(seed)
    want = brute(rows, least=8)
    assert got(collocations.collocations(make_docs([(1, *r) for r in rows]), least=8)) == want and len(want) > 30


def test_hot_prefixes_and_a_full_filter_change_nothing(spark, make_docs, small):
    rows = corpus(3, 200)
    assert got(collocations.collocations(make_docs([(1, *r) for r in rows]), least=6, top=15)) == brute(rows, least=6, top=15)


def lots(texts, size, lot, piece):
    """Stripes of the texts of one language as a counter of phrases, lot words at a time."""
    out, now = Counter(), collocations.Lot("x")

    def flush(open_end):
        nonlocal now
        batches, rest = now.stripes(size, None, set(), open_end)
        for b in batches:
            for prefix, nexts, counts in zip(b["prefix"].to_pylist(), b["nexts"].to_pylist(), b["counts"].to_pylist(), strict=True):
                for word, n in zip(nexts, counts, strict=True):
                    out[(prefix + b" " + word).strip()] += n
        now = collocations.Lot("x")
        now.add(rest)

    for text in texts:
        for part in collocations.tokens(text.encode(), piece):
            now.add(part)
            if now.size >= lot:
                flush(True)
    flush(False)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_phrases_over_the_ends_of_lots_and_pieces_count_once(size):
    texts = [t for t, _ in corpus(4, 40)] + ["a b c d e " * 50, "", "a", "x" * 300 + " b"]
    want = lots(texts, size, 1 << 30, 1 << 20)
    for lot, piece in [(1, 10), (2, 1), (7, 50), (40, 1 << 20)]:
        assert lots(texts, size, lot, piece) == want


def test_a_long_text_without_separators(spark, make_docs):
    rng = random.Random(5)
    rows = [(" ".join(rng.choices([f"word{i}" for i in range(30)], k=400_000)), "en")]
    got_rows = got(collocations.collocations(make_docs([(1, *rows[0])]), least=500, longest=3))
    assert got_rows == brute(rows, least=500, longest=3) and got_rows


def test_odd_texts_languages_and_empty_tables(spark, make_docs):
    rows = [(t, lang) for t in [*ODD_TEXTS, "a\x1cb \xa0 a\x1cb \xa0 x", "A B.A B"] for lang in ("en", None, "", "und")] * 2
    assert got(collocations.collocations(make_docs([(None, *r) for r in rows]), least=2)) == brute(rows, least=2)
    assert collocations.collocations(make_docs([(1, "x", "en")]).limit(0)).count() == 0
    assert collocations.collocations(make_docs([(1, None, None)])).count() == 0


def test_counts_past_64_bits_of_products(spark, make_docs, monkeypatch):
    """Scores and shares of counts near 2 ** 62."""
    docs = make_docs([(1, "a b a b a b a b a b. c", "en")])
    plain = collocations.stripes

    def large(*args):
        return plain(*args).withColumn("f", F.col("f") * F.lit(2**58))

    monkeypatch.setattr(collocations, "stripes", large)
    rows = collocations.collocations(docs, least=2, longest=3).collect()
    # Four of each; the lower cut is between the pair that occurs five times and the word.
    assert {(r["phrase"], r["a"], r["score"]) for r in rows} == {
        ("b a b", 4 << 58, 2000000 * 4 // 10), ("a b a", 4 << 58, 2000000 * 4 // 10)
    }


def test_filter_finds_every_phrase_that_was_put_in(spark):
    rows = [("en", f"a{i} é{i % 7}") for i in range(500)]
    bits = collocations._filter(spark.createDataFrame(rows, "lang string, phrase string"))
    base = np.full(1, collocations.xxhash.xxh3_64_intdigest(b"en"), np.uint64)
    for _, phrase in rows:
        name = base
        for w in collocations.named(phrase.encode().split(b" ")):
            name = collocations.longer(name, np.array([w]))
        assert collocations.has(bits, name).all()
