from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from freshet.llm import language_id, quality_classifier
from tests.llm.conftest import ODD_TEXTS, text
from tests.llm.test_jaccard_join import brute, edited, words

DATA = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "best-fit packing"]


def test_run_against_its_stages_by_hand(spark):
    """Every stage's rows from the one before, by the plain meaning of the stage."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = model.scores(*quality_classifier.encode_passages(list(left.values())))
    left = {k: t for (k, t), s in zip(left.items(), found, strict=True) if s >= quality_classifier.THRESHOLD}
    net = language_id.fit(docs.filter(docs.doc_id.isin(list(left))))
    said = language_id.predict_texts(net, list(left.values()))
    left = {k: t for (k, t), (v, s) in zip(left.items(), said, strict=True) if v != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    left = {k: left[k] for k, _, c in brute(list(left.items()))[0] if k == c}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in left.items()}
    got: dict[int, int] = {}
    for r in corpus_pipeline.run(spark, DATA).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == sizes


def test_deduplication_keeps_one_of_a_group_and_all_columns(spark, make_docs):
    base = words(80, 1)
    docs = make_docs([(4, edited(base, 1, 1)), (2, " ".join(base)), (2, " ".join(base)), (9, text(50, 5)), (7, None), (8, None), (None, "own text here"), (None, "own text here")])
    out = corpus_pipeline.deduplicated(spark, docs, DATA)
    assert out.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in out.collect())) == ["2", "7", "8", "9", "None"]


def test_filters_keep_rows_whole(spark, make_docs):
    rows = [(k, text(60, k, "abcde" if k % 2 else "vwxyz"), "one" if k % 2 else "two") for k in range(60)]
    docs = make_docs([*rows, *((100 + k, t) for k, t in enumerate(ODD_TEXTS)), (None, "abcde abcde")])
    known = corpus_pipeline.known_language(spark, docs, DATA)
    assert known.columns == docs.columns
    got = {r["doc_id"]: r for r in known.collect()}
    assert set(range(60)) <= set(got) and 100 not in got and 101 not in got
    assert got[1]["score"] == -1.0 and got[1]["lang_pred"] == "xx"  # columns that stages use themselves
    good = corpus_pipeline.good_quality(spark, docs, DATA)
    assert good.columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), DATA).count() == 0


def test_deduplication_decides_by_row(spark, make_docs):
    a, b, c = (words(80, k) for k in (1, 2, 3))
    docs = [(1, " ".join(a)), (1, " ".join(b)), (2, edited(b, 1, 1)), (3, " ".join(c)), (4, edited(a, 2, 1))]
    docs += [(None, " ".join(c)), (None, edited(c, 3, 1)), (None, None), (5, edited(c, 4, 1)), (5, text(50, 9)), (5, None)]
    out = corpus_pipeline.deduplicated(spark, make_docs(docs), DATA).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    want = [docs[0], docs[1], docs[3], docs[7], docs[9], docs[10]]
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=key) == sorted(want, key=key)


def test_deduplication_without_ids(spark, make_docs):
    a, b = words(80, 11), words(80, 12)
    docs = [(None, " ".join(a)), (None, edited(a, 1, 1)), (None, " ".join(a).upper()), (None, " ".join(b)), (None, edited(b, 2, 1)), (6, edited(b, 3, 1)), (None, ""), (None, None), (None, "lone words")]
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.deduplicated(spark, make_docs(docs), DATA).collect()]
    assert len(out) == 5 and out.count((None, "")) == out.count((None, None)) == out.count((None, "lone words")) == 1
    assert (6, docs[5][1]) in out and sum((r in docs[:3]) for r in out) == 1
