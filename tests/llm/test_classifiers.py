from __future__ import annotations

import zlib

import numpy as np
import pytest

from freshet.llm import language_id, quality_classifier
from freshet.llm.queries import op3_quality_classifier, op7_language_id
from tests.llm.conftest import ODD_TEXTS, text

DATA = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in op3_quality_classifier(spark, DATA).collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    out = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels if held(r["doc_id"])]
    for quality in (0, 1):
        right = [p == q for p, q in out if q == quality]
        assert np.mean(right) >= 0.85


def test_quality_does_not_learn_from_held_out_labels(spark, make_docs):
    docs = make_docs([(k, text(60, k)) for k in range(60)])
    labels = [(k, 1 if k % 2 else 0, 0) for k in range(60)]
    turned = [(k, 1 - q if held(k) else q, t) for k, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    one, two = (quality_classifier.fit(docs, spark.createDataFrame(x, schema)) for x in (labels, turned))
    assert all((a == b).all() for a, b in zip(one.values, two.values, strict=True))


def test_quality_of_odd_texts_and_labels(spark, make_docs):
    docs = make_docs([(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a"), (3, "x"), (3, "x")])
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (4, 1), (4, 0), (6, 1), (7, 1), (8, 0)], "doc_id long, quality int")
    rows = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 2  # "\n\t " once, "x" twice
    none = spark.createDataFrame([], "doc_id long, quality int")
    scores = [r["score"] for r in quality_classifier.score(docs, quality_classifier.fit(docs, none)).collect()]
    assert scores == pytest.approx([1.0] * len(scores), abs=1e-3)
    empty = make_docs([])
    assert quality_classifier.score(empty, quality_classifier.fit(empty, none)).count() == 0


def test_passages_cover_whole_texts_and_long_ones(monkeypatch):
    t = text(2000, 3)
    x, starts = quality_classifier.encode_passages([None, t, "", t])
    assert np.diff(starts).tolist() == [1, -(-len(t) // 512), 1, -(-len(t) // 512)]
    assert (x[starts[1] : starts[2]] == x[starts[3] : starts[4]]).all()
    changed, _ = quality_classifier.encode_passages([t[:-20] + "!" * 20])
    assert (changed[-1] != x[starts[2] - 1]).any()
    monkeypatch.setattr(quality_classifier, "BLOCK", 1024)
    blocks, again = quality_classifier.encode_passages([None, t, "", t])
    assert (again == starts).all() and np.allclose(blocks[:, :256], x[:, :256])


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, starts, truth = rng.normal(size=(9, quality_classifier.FEATURES)).astype(np.float32), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = quality_classifier.train(x, starts, truth, epochs=60)
    f = model.bags(x, starts)
    assert np.allclose(np.add.reduceat(f["weight"], starts[:-1]), 1)
    assert ((f["score"] > 0.5) == (truth == 1)).all()


def test_language_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in op7_language_id(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert len(got) == len(docs) and all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in got.items())
    right = [got[d["doc_id"]]["lang_pred"] == d["lang"] for d in docs if held(d["doc_id"]) and d["lang"]]
    assert np.mean(right) >= 0.97


def test_language_of_odd_texts(make_docs):
    rows = [(k, text(80, k, "abcde" if k % 2 else "vwxyz"), "one" if k % 2 else "two") for k in range(80)]
    docs = make_docs(rows + [(100, None, "one"), (101, "12 !!", "two"), (102, "abcde", None), (None, "vwxyz", "two"), (1, rows[1][1], "one")])
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(out) == 85
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert found[100] == found[101] == ("und", 0.0)
    assert all(found[k][0] == ("one" if k % 2 else "two") for k in range(80))
    assert found[102][0] == "one" and found[None][0] == "two"
    unlabelled = make_docs([(1, "abc"), (2, None)])
    assert {r["lang_pred"] for r in language_id.predict(unlabelled, language_id.fit(unlabelled)).collect()} == {"und"}
    empty = make_docs([])
    assert language_id.predict(empty, language_id.fit(empty)).count() == 0


def test_language_uses_the_whole_text_and_ignores_held_out_rows(make_docs):
    rows = [(k, text(80, k, "abcde" if k % 2 else "vwxyz"), "one" if k % 2 else "two") for k in range(60)]
    net = language_id.fit(make_docs(rows))
    turned = language_id.fit(make_docs([(i, t, "three" if held(i) else v) for i, t, v in rows]))
    assert net.languages == turned.languages and (net.filters == turned.filters).all()
    mostly = text(20, 1, "abcde") + " " + text(400, 2, "vwxyz")
    assert language_id.predict_texts(net, [mostly])[0][0] == "two"


def test_pooling_is_the_largest_answer_of_every_filter():
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 256, (3, language_id.WINDOW)).astype(np.uint8)
    net = language_id.train(windows, np.array([0, 1, 0]), ["a", "b"], epochs=2)
    e, wide = language_id.EMBEDDING, max(language_id.WIDTHS)
    x = net.embedding[windows[0]]
    want = np.max([x[t : t + wide].reshape(-1) @ net.filters for t in range(len(x) - wide + 1)], axis=0)
    assert np.allclose(net.pooled(windows)[0], np.maximum(want + net.bias, 0), atol=1e-5)
    for k, w in enumerate(language_id.WIDTHS):
        assert not net.filters[w * e :, k * language_id.FILTERS : (k + 1) * language_id.FILTERS].any()


def test_few_ids_of_a_language(spark):
    """Bounded for a hot id and a hot language, nearly all the smallest hashes, whole where there are few."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 10 = 0, 'b', 'a') AS lang").unionByName(
        spark.range(10_000).selectExpr("7L AS doc_id", "'a' AS lang")
    )
    got = language_id.few_ids(rows, 100).collect()
    by_lang = {lang: {r["doc_id"] for r in got if r["lang"] == lang} for lang in ("a", "b")}
    assert len(got) == 200 and all(len(ids) == 100 for ids in by_lang.values())
    hashes = {r["doc_id"]: r["h"] for r in rows.distinct().selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    for lang, ids in by_lang.items():
        best = sorted((i for i in hashes if (i % 10 == 0) == (lang == "b")), key=hashes.get)[:100]
        assert len(ids & set(best)) >= 95
    few = language_id.few_ids(rows.filter("doc_id < 40").distinct(), 100)
    assert few.count() >= 38
    assert language_id.few_ids(rows.limit(0), 100).count() == 0
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan
