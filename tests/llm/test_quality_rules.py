from __future__ import annotations

import math
import random
import re
from collections import Counter
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from freshet.llm import quality_rules
from freshet.llm.queries import op10_quality_rules
from tests.llm.conftest import DATA, ODD_TEXTS, text


def brute(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    repeat = len(inside)
    failed = len(w) < 10 or 100 * repeat > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat, failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(make_docs):
    rng = random.Random(2)
    texts = [*ODD_TEXTS, "a b c d e", "a b c d e a b c d e", "x " * 50, "l one\nl one\n\n \nl two\nl one", "\x0b\x0c a\x1cb | # <>"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(40)] + [text(300, 1) + " " + text(300, 1)]
    rows = quality_rules.with_base(make_docs(list(enumerate(texts)))).collect()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == brute(r["text"]), r["text"]


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.02), (20, 900, 0.05), (0, 5000, 0.01), (40, 5000, 0.01)]
    df = spark.createDataFrame([(k, n) for k, n, _ in cases], "k long, n long")
    for (k, n, p), row in zip(cases, df.collect(), strict=True):
        one = spark.createDataFrame([row]).select(quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).first()[0]
        assert one == pytest.approx(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)), rel=1e-9)


def test_the_tail_is_exact_at_all_sizes(spark):
    """Against sums of fifty digits; at the mean and some deviations below."""
    p = Fraction(1, 100)
    cases = [(n, int(n * p) - int(d * math.sqrt(n * 0.0099))) for n in (40, 3000, 200_000, 1_000_000) for d in (0, 1, 4) if n * p >= d * math.sqrt(n * 0.0099)]
    df = spark.createDataFrame(cases, "n long, k long")
    got = {(r[0], r[1]): r[2] for r in df.select("n", "k", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect()}
    with localcontext() as c:
        c.prec = 50
        for n, k in cases:
            term = Decimal(comb(n, k)) * Decimal(1) / Decimal(100) ** k * (Decimal(99) / Decimal(100)) ** (n - k)
            total = Decimal(0)
            for i in range(k, -1, -1):
                total += term
                if term < total * Decimal("1e-30"):
                    break
                term = term * i / (n - i + 1) * 99
            assert got[n, k] == pytest.approx(float(total), rel=1e-8), (n, k)


def test_the_tail_of_ten_billion_labels(spark):
    df = spark.createDataFrame([(10**10, 10**8), (10**10, 10**8 - 50_000)], "n long, k long")
    middle, low = (r[0] for r in df.select(quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect())
    assert middle == pytest.approx(0.5, abs=1e-4)
    deviations = 50_000 / math.sqrt(10**10 * 0.0099)
    assert low == pytest.approx(0.5 * math.erfc(deviations / math.sqrt(2)), rel=1e-2)


def marked(n_good, n_bad, bad_good=0):
    """Good texts, bad ones full of marks, and good ones that look bad."""
    docs, labels = [], []
    for k in range(n_good + n_bad + bad_good):
        bad = k >= n_good
        t = text(40, k)
        docs.append((k, " ".join(f"{w}###" for w in t.split()) if bad else t))
        labels.append((k, 0 if n_good <= k < n_good + n_bad else 1, 0))
    return docs, labels


LABELS = "doc_id long, quality int, stratum int"


def test_a_cutoff_needs_enough_good_documents(spark, make_docs):
    for n_good, allowed in ((1100, True), (600, False)):
        docs, labels = marked(n_good, 60)
        rows = quality_rules.quality_rules(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
        kept = {r["doc_id"]: r["kept"] for r in rows}
        assert all(kept[k] for k in range(n_good) if not brute(docs[k][1])[5])
        assert any(kept[k] for k in range(n_good, n_good + 60)) != allowed


def test_false_rejections_forbid_a_cutoff(spark, make_docs):
    docs, labels = marked(1100, 60, bad_good=30)
    rows = quality_rules.quality_rules(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()
    assert all(r["kept"] for r in rows if not r["base_failed"])


def test_odd_rows_and_labels(spark, make_docs):
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, text(30, 1)), (2, text(30, 2)), (2, text(30, 2))]
    labels = spark.createDataFrame([(2, None, 1), (None, 1, 1), (3, 0, 1), (3, 1, 1), (2, 1, 0)], LABELS)
    rows = quality_rules.quality_rules(make_docs(docs), labels).collect()
    assert len(rows) == len(docs) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    none = spark.createDataFrame([], LABELS)
    assert quality_rules.quality_rules(make_docs([]), none).count() == 0
    assert quality_rules.quality_rules(make_docs(docs), none).count() == len(docs)


def test_query_is_native(spark):
    df = op10_quality_rules(spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert df.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
