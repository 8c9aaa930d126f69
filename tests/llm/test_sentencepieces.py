from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from freshet.llm import sentencepieces
from freshet.llm.queries import op9_sentencepiece
from tests.llm.conftest import DATA, ODD_TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sentencepieces.Model(PATH)


def random_texts():
    rng = random.Random(1)
    return ["".join(rng.choice(" ▁ab\n.é🙂\x00") for _ in range(rng.randint(0, 14))) for _ in range(2000)]


def test_ids_and_spans_against_the_library(model, library):
    for t in [*ODD_TEXTS[1:], " ", "  ", "a ", "▁", " ▁", *random_texts()]:
        ids, starts, ends = model.encode(t)
        assert ids.tolist() == library.encode(t, add_eos=True), t[:40]
        raw = t.encode()
        # Spans go through the text without gaps, and hold what their pieces say.
        assert starts[0] == 0 and (starts[1:] == ends[:-1]).all() and starts[-1] == ends[-1] == len(raw)
        for i, a, b in zip(ids[:-1].tolist(), starts, ends, strict=False):
            if not library.is_byte(i):
                said = raw[a:b].decode().replace(" ", "▁")
                assert said in (library.id_to_piece(i), library.id_to_piece(i)[1:])


def test_query_round_trip(spark, library):
    got = {r["doc_id"]: r for r in op9_sentencepiece(spark, DATA).collect()}
    for d in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        ids = library.encode(d["text"] or "", add_eos=True)
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows_in_a_table(make_docs, library):
    docs = make_docs([(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "a b"), (1, ""), (1, "")])
    encoded = sentencepieces.encode(docs, PATH, out="score")  # replaces a column of that name
    rows = sentencepieces.decode(encoded, PATH, "score.ids", "back").collect()
    assert len(rows) == len(ODD_TEXTS) + 3 and rows[0]["lang_pred"] == "xx"
    for r in rows:
        assert r["score"]["ids"] == library.encode(r["text"] or "", add_eos=True)
        assert r["back"] == library.decode(r["score"]["ids"])
    empty = sentencepieces.encode(make_docs([]), PATH)
    assert sentencepieces.decode(empty, PATH).count() == 0


@pytest.mark.parametrize("squeeze", [False, True])
def test_compiled_character_map_against_the_library(squeeze):
    """A map that changes text: the library's compiled compatibility rules."""
    rule = sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc", add_dummy_prefix=True, remove_extra_whitespaces=squeeze, escape_whitespaces=False
    )
    spec = rule.serialized_normalizer_spec
    blob = dict(sentencepieces._fields(spec() if callable(spec) else spec))[2]
    model = sentencepieces.Model.__new__(sentencepieces.Model)
    model.map, model.dummy, model.squeeze = sentencepieces.CharacterMap(bytes(blob)), True, squeeze
    for t in ["ｱｲｳ ㌔ ﬁn ①  x", "ABC　def ", "é", "가각", "  a  b  ", "½ ㍿ Ａ", "", "plain"]:
        plain, places = model.normalized(t)
        assert plain == rule.normalize(t)
        raw = t.encode()
        assert len(places) == len(plain.encode()) + 1 and (np.diff(places) >= 0).all() and (places <= len(raw)).all()
    plain, places = model.normalized("x㌔y")
    at = plain.encode().index(b"y")
    assert plain == " xキロy" and places[at] == 4 and places[2] == 1  # the whole sign stands for its letters


def test_columns_of_the_same_names_are_kept(spark):
    docs = spark.createDataFrame([(1, "one text", "a", "b", "c"), (2, None, "d", "e", "f")], "doc_id long, text string, _ids string, encoded string, decoded string")
    encoded = sentencepieces.encode(docs, PATH)
    assert encoded.columns == [*docs.columns, "_encoded"]
    rows = sentencepieces.decode(encoded, PATH, "_encoded.ids").orderBy("doc_id").collect()
    assert rows[0].__fields__ == [*encoded.columns, "_decoded"]
    assert [(r["_ids"], r["encoded"], r["decoded"]) for r in rows] == [("a", "b", "c"), ("d", "e", "f")]
    assert [r["_decoded"] for r in rows] == ["one text", ""]
    again = sentencepieces.decode(encoded, PATH, "_encoded.ids", "decoded")
    assert again.columns == ["doc_id", "text", "_ids", "encoded", "_encoded", "decoded"]
