from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from freshet.llm.shared import ship_package  # noqa: E402

DATA = "/root/testdata/sf0.001"

#: Extra columns take names that operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, score double, key long, lang_pred string, copy long, slot int, shard string"


@pytest.fixture(autouse=True, scope="session")
def _package(spark):
    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", -1.0, 5, "xx", 9, 1, "old") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def words(n: int, seed: int, letters: str = "abcdefgh") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def text(n: int, seed: int, letters: str = "abcdefgh") -> str:
    return " ".join(words(n, seed, letters))


ODD_TEXTS = [
    None, "", " ", "\n\t ", "x", "é́ Ünïcödé ½ ﬁ", "日本語 テスト 。", "a\x1cb\x00c", "🙂 🙂🙂", "it's we'll, DON'T. <|endoftext|> x</s>",
    "a  b   c\n\n d ", "▁a▁ b", "Σας ΟΔΟΣ İstanbul", "word, " * 3000,
]
