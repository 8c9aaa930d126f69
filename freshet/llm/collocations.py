"""Phrase collocations from stripes.

Every prefix of words, the empty one first, keys an associative counter of the
words that follow it: its stripe. One table of stripes has it all: the entry of a
word in a prefix's stripe is the count of the phrase of both, the entries of
prefixes a word shorter are the prefixes' totals, and an entry is also what
subsumes the two phrases it holds, its prefix and the same words without the first.

A task counts stripes of the texts it reads, LOT_WORDS words at a time; they are
merged elementwise behind a shuffle by prefix. Stripes of longer prefixes are made
only where both shorter phrases are frequent: phrases with at least `least`
occurrences set bits of a filter of FILTER_BITS bits, whatever their number. Phrases
that only share bits are counted as well and dropped by their own counts, so a
full filter costs time and no result. The stripe of a prefix that holds more than
1 / HOT of all words, fewer than HOT prefixes of a length, and that of the empty
one are dealt out by their next words.

Lower case is that of A-Z. Separators end a piece, a phrase stays within one; words
are runs of bytes other than space and tab. A null text is empty, a null language
is `und`. Ids are not read: repeated rows count again. Texts are cut into words a
megabyte at a time. Other columns are ignored. An empty table gives no rows. The
space between words of a result is one space, and phrases order by their bytes.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.shared import chunks, mixed, written
from freshet.operators.skew import spread_join

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Words that a task counts before it hands on its stripes.
LOT_WORDS = 3_000_000
PIECE = 1 << 20
FILTER_BITS = 1 << 26
HOT = 1024
#: Parts of a stripe that is dealt out.
PARTS = 64

#: No byte of valid text; stands for the end of a piece.
BREAK = b"\xff"
_PLAIN = bytes(
    0xFF if c in SEPARATORS else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256)
)
_END = re.compile(rb"[ \xff]")

STRIPES = "lang string, prefix binary, part int, nexts array<binary>, counts array<long>"


def tokens(text: bytes, size: int = PIECE):
    """Lists of words and BREAKs; a BREAK behind the text."""
    plain, start = text.translate(_PLAIN), 0
    while start < len(plain):
        end = len(plain)
        if end - start > size:
            gap = _END.search(plain, start + size)
            end = gap.start() if gap else end
        yield plain[start:end].replace(BREAK, b" \xff ").split(b" ")
        start = end
    yield [BREAK]


def named(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word; the language is the empty phrase."""
    return mixed(phrase * np.uint64(0x9E3779B97F4A7C15) + word)


class Lot:
    """The words of one language that a task has read and not yet counted."""

    def __init__(self, lang: str):
        self.lang, self.size = lang, 0
        # The empty word comes of neighbouring spaces and is taken out.
        self.names: dict[bytes, int] = {BREAK: 0, b"": 1}
        self.parts: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        names = self.names
        for w in set(words):
            if w not in names:
                names[w] = len(names)
        ids = np.fromiter(map(names.__getitem__, words), np.int32, len(words))
        ids = ids[ids != 1]
        self.parts.append(ids)
        self.size += len(ids)

    def stripes(self, count: int, frequent: np.ndarray | None, hot: set, open_end: bool) -> tuple[list[pa.RecordBatch], list[bytes]]:
        """Stripes of the phrases of count words, and the words to begin the next lot
        with: with an open end, phrases that reach over the end are its."""
        ids = np.concatenate(self.parts)
        words = list(self.names)
        rest = [words[i] for i in ids[len(ids) - count + 1 :]] if open_end and count > 1 else []
        if not open_end:
            ids = np.concatenate([ids, np.zeros(count, np.int32)])
        n = len(ids) - count + 1
        if n <= 0:
            return [], [words[i] for i in ids] if open_end else []
        place = np.ones(n, bool)
        for k in range(count):
            place &= ids[k : k + n] != 0
        if frequent is not None:
            hashes = named(words)
            base = np.full(n + 1, xxhash.xxh3_64_intdigest(self.lang.encode()), np.uint64)
            for k in range(count - 1):
                base = longer(base, hashes[ids[k : k + n + 1]])
            known = has(frequent, base)
            place &= known[:-1] & known[1:]
        at = np.flatnonzero(place)
        if not len(at):
            return [], rest
        # Words are numbered by their part, so that a stripe's parts lie together.
        part = np.fromiter((w[-1] * 7 + w[0] * 31 + len(w) if w else 0 for w in words), np.int64, len(words)) % PARTS
        order = np.argsort(part, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        # Prefixes as numbers: of the first word, then of the pairs with the next one, ...
        prefix, shown = np.zeros(len(at), np.int64), [np.zeros(1, np.int64)]
        for k in range(count - 1):
            if k == 0:
                prefix, shown = ids[at].astype(np.int64), [np.arange(len(words))]
                continue
            both, prefix = np.unique(prefix * len(words) + ids[at + k], return_inverse=True)
            shown = [s[both // len(words)] for s in shown] + [both % len(words)]
        keys, counts = np.unique(prefix * len(words) + rank[ids[at + count - 1]], return_counts=True)
        prefix, nexts = keys // len(words), order[keys % len(words)]
        first = np.flatnonzero(np.diff(prefix, prepend=-1))
        names = [b" ".join(words[s[p]] for s in shown) if count > 1 else b"" for p in prefix[first].tolist()]
        dealt = np.array([count == 1 or x in hot for x in names], bool)
        which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        parts = np.where(dealt[which], part[nexts], 0)
        begins = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(parts, prepend=-1) != 0))
        word = pa.array(words, pa.binary())
        out = []
        for a in range(0, len(begins), 100_000):
            some = begins[a : a + 100_000]
            stop = begins[a + 100_000] if a + 100_000 < len(begins) else len(keys)
            offsets = pa.array(np.append(some, stop) - some[0], pa.int32())
            here = slice(some[0], stop)
            columns = [
                pa.array([self.lang] * len(some), pa.string()),
                pa.array(names, pa.binary()).take(pa.array(which[some])),
                pa.array(parts[some], pa.int32()),
                pa.ListArray.from_arrays(offsets, word.take(pa.array(nexts[here]))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[here], pa.int64())),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", "nexts", "counts"]))
        return out, rest


def has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filter(entries: DataFrame) -> np.ndarray:
    """Bits of the phrases, one in FILTER_BITS each: gathered as sums of 63 bits."""

    def run(batches):
        for batch in batches:
            langs, phrases = (batch.column(c).to_pylist() for c in (0, 1))
            at = []
            for lang, phrase in zip(langs, phrases, strict=True):
                words = named(phrase.split(b" "))
                base = np.full(1, xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
                at.append(reduce(lambda b, w: longer(b, words[w : w + 1]), range(len(words)), base)[0])
            place = np.array(at, np.uint64) & np.uint64(FILTER_BITS - 1)
            yield pa.RecordBatch.from_arrays([pa.array((place // 63).astype(np.int64)), pa.array(np.int64(1) << (place % 63).astype(np.int64))], ["slot", "bit"])

    rows = entries.select("lang", F.col("phrase").cast("binary")).mapInArrow(run, "slot long, bit long")
    slots = rows.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    at, bits = slots.column("slot").to_numpy(), slots.column("bits").to_numpy()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for k in range(63):
        place = at[(bits >> k) & 1 == 1] * 63 + k
        np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out


def _stripes(texts: DataFrame, count: int, frequent: np.ndarray | None, hot: dict[str, set]) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast((frequent, hot))

    def run(batches):
        bits, special = sent.value
        lots: dict[str, Lot] = {}
        total = 0

        def flush(open_for: str | None):
            for lang in list(lots):
                lot = lots.pop(lang)
                rows, rest = lot.stripes(count, bits, special.get(lang, set()), lang == open_for)
                yield from rows
                if rest:
                    lots[lang] = Lot(lang)
                    lots[lang].add(rest)

        for part in chunks(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                for words in tokens(text):
                    lot = lots.get(lang) or lots.setdefault(lang, Lot(lang))
                    lot.add(words)
                    total += len(words)
                    if total >= LOT_WORDS:
                        yield from flush(lang)
                        total = 0
        yield from flush(None)

    return texts.mapInArrow(run, STRIPES)


def stripes(docs: DataFrame, least: int, longest: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, size, prefix, next, phrase, f) of every phrase of up to longest words with
    at least `least` occurrences; and of size 0, each language's words, as f.

    A written table: the merged stripes without their rare entries.
    """
    name = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN))
    texts = docs.select(name.alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))
    frequent, hot, out = None, {}, []
    for size in range(1, longest + 1):
        dealt = _stripes(texts, size, frequent, hot).repartition("lang", "prefix", "part")
        entries = dealt.select("lang", "prefix", "part", F.inline(F.arrays_zip(F.col("nexts").alias("next"), F.col("counts").alias("n"))))
        merged = entries.groupBy("lang", "prefix", "part", "next").agg(F.sum("n").alias("f"))
        if size == 1:
            # The empty prefix has all words: kept whole until its total is taken.
            merged = written(merged)
            total = merged.groupBy("lang").agg(F.sum("f").alias("f"))
            out.append(written(total.select("lang", F.lit(0).alias("size"), F.lit("").alias("prefix"), F.lit("").alias("next"), F.lit("").alias("phrase"), "f")))
        prefix, word = F.col("prefix").cast("string"), F.col("next").cast("string")
        phrase = F.when(prefix == "", word).otherwise(F.concat_ws(" ", prefix, word))
        kept = merged.filter(F.col("f") >= least).select("lang", F.lit(size).alias("size"), prefix.alias("prefix"), word.alias("next"), phrase.alias("phrase"), "f")
        out.append(written(kept))
        if size < longest:
            frequent = _filter(out[-1])
            most = out[0].agg(F.sum("f")).scalar()
            hot = {}
            for row in out[-1].filter(F.col("f").cast("decimal(38,0)") * HOT > most).select("lang", F.col("phrase").cast("binary")).collect():
                hot.setdefault(row[0], set()).add(bytes(row[1]))
    return reduce(DataFrame.union, out)


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, share: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    score: floor(2000000 a / (l + r)) of the cut with the lowest one, the first of
    equal ones. A phrase that stands in a longer one with at least share percent of
    its occurrences is left out; then also in one with one word more, whose own
    occurrences are no fewer.
    """
    found = stripes(docs, least, longest, text, lang)
    counts = found.filter("size >= 1").select("lang", "phrase", F.col("f").cast("decimal(20,0)").alias("f"))
    words = F.split("phrase", " ")
    asked = found.filter("size >= 2").select("lang", "size", "prefix", "phrase", F.col("f").cast("decimal(20,0)").alias("a"), words.alias("words"))
    rest = F.array_join(F.slice("words", 2, longest), " ")
    inner = asked.filter("size >= 3").select("lang", F.explode(F.array("prefix", rest)).alias("phrase"), "a")
    over = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = asked.join(over, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        F.col("phrase").alias("whole"),
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("second"),
    )
    for side, out in (("first", "l"), ("second", "r")):
        cuts = spread_join(cuts, counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(out)), ["lang", side], ["whole", "k"])
    score = F.expr("cast(cast(a * 2000000 as decimal(38,0)) div cast(l + r as decimal(38,0)) as bigint)")
    best = cuts.groupBy("lang", "whole", "a").agg(F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "whole")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = found.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        F.col("whole").alias("phrase"),
        F.col("a").cast("long").alias("a"),
        F.col("cut.l").cast("long").alias("l"),
        F.col("cut.r").cast("long").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )
