"""Periodic runs of words: a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q, of at least LEAST words and
REPEATS periods, that no neighbouring word extends. The words of a text are put
into a suffix automaton; then they are gone through once more, and the path from
the state of each prefix to the root is accessed as in link-cut trees, which
recolours it with the prefix's end. The path falls into segments of one colour: the
longest state of a segment is the longest suffix of this prefix that ended last at
the segment's colour. If the distance p of the two ends is at most the length of
that state, the prefix ends in a square of period p, and period p reaches back the
length plus p words. Where the next word does not go on with it, that is a run.
The suffix occurs nowhere between the two ends, so p is the smallest period, and
it is the longest, so the word before does not belong to it.

Only words that can be in a run go into an automaton. In a run of so many words
every GRAM words that follow each other are found again at distance q, a quarter
of the run at most. Grams that are not found again within a quarter of the stretch
of such grams that they stand in are taken out, until nothing changes; what
remains are mostly runs themselves.

A null text has no words. A text is handled alone: repeated rows give repeated
results, null or repeated ids do not matter. Long texts are cut into words a
megabyte at a time; a word takes 30 bytes then, and some hundred in an automaton.
Carried columns may have any names but those of the results, which are refused. An
empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from freshet.llm.shared import chunks, mixed

LEAST = 6
REPEATS = 4
#: For LEAST 6 and REPEATS 4: all grams of a run have a copy a period away.
GRAM = 5
PIECE = 1 << 20

RUN = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
_GAP = re.compile(rb"[ \t-\r]")


def pieces(text: bytes, size: int = PIECE):
    """The text in parts of about size bytes that end where a word does."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end
    yield text[start:] if start else text


class Words(dict):
    """Numbers of words, given as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbers(text: bytes, names: Words) -> np.ndarray:
    parts = [np.fromiter(map(names.__getitem__, p.split()), np.int64) for p in pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _stretches(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind the last of each stretch of marked places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def candidates(words: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """[first, behind the last) words of stretches that hold all runs; text: the
    number of the text that each word is of."""
    n = len(words) - GRAM + 1
    if n < LEAST - GRAM + 1:
        return []
    name = text[:n].astype(np.uint64)
    for k in range(GRAM):
        name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k].astype(np.uint64))
    order = np.argsort(name, kind="stable")
    away = np.full(n, np.iinfo(np.int64).max)
    # Places of equal grams follow each other in order; equal hashes of other grams only cost time.
    equal = np.flatnonzero(name[order[1:]] == name[order[:-1]])
    a, b = order[equal], order[equal + 1]
    away[a] = b - a
    away[b] = np.minimum(away[b], b - a)
    away[text[:n] != text[GRAM - 1 :]] = np.iinfo(np.int64).max
    marked = away < len(words)
    while True:
        first, last = _stretches(marked)
        size = np.repeat(last - first + GRAM - 1, last - first)
        at = np.flatnonzero(marked)
        keep = (size >= LEAST) & (away[at] * REPEATS <= size)
        if keep.all():
            return list(zip(first.tolist(), (last + GRAM - 1).tolist(), strict=True))
        marked[at[~keep]] = False


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(links, lengths, states of the prefixes) of the suffix automaton."""
    link, length, after, last, ends = [-1], [0], [{}], 0, []
    for w in words:
        state = len(length)
        length.append(length[last] + 1)
        after.append({})
        link.append(0)
        p = last
        while p >= 0 and w not in after[p]:
            after[p][w] = state
            p = link[p]
        if p >= 0:
            q = after[p][w]
            if length[q] != length[p] + 1:
                copy = len(length)
                length.append(length[p] + 1)
                after.append(after[q].copy())
                link.append(link[q])
                while p >= 0 and after[p].get(w) == q:
                    after[p][w] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[state] = q
        last = state
        ends.append(state)
    return link, length, ends


class Paths:
    """Preferred paths of a tree as splay trees; each has one colour, kept at its root."""

    def __init__(self, parent: list[int]):
        n = len(parent)
        self.up = parent[:]  # in a splay tree its parent, at its root the path's parent
        self.upper, self.lower = [-1] * n, [-1] * n
        self.colour = [-1] * n

    def _splay(self, x: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        top = True
        while (y := up[x]) >= 0 and (upper[y] == x or lower[y] == x):
            z = up[y]
            top = z < 0 or (upper[z] != y and lower[z] != y)
            if not top and (upper[z] == y) == (upper[y] == x):
                self._rotate(y)
            elif not top:
                self._rotate(x)
                continue
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        y = up[x]
        z = up[y]
        if upper[y] == x:
            upper[y] = c = lower[x]
            lower[x] = y
        else:
            lower[y] = c = upper[x]
            upper[x] = y
        if c >= 0:
            up[c] = y
        up[y], up[x] = x, z
        if z >= 0 and upper[z] == y:
            upper[z] = x
        elif z >= 0 and lower[z] == y:
            lower[z] = x
        else:
            self.colour[x] = self.colour[y]

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Recolours the path from x to the root. Returns (node, colour) of the
        deepest node of every segment it had, from x up."""
        up, lower, colours = self.up, self.lower, self.colour
        below, out = -1, []
        while x >= 0:
            self._splay(x)
            own = colours[x]
            if own >= 0:
                out.append((x, own))
            if lower[x] >= 0:
                colours[lower[x]] = own
            lower[x] = below
            below, x = x, up[x]
        colours[below] = colour
        return out


def runs(words: list[int], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period."""
    link, length, ends = automaton(words)
    paths, n, out = Paths(link), len(words), []
    for end, state in enumerate(ends):
        for node, before in paths.access(state, end):
            p, own = end - before, length[node]
            if own >= (repeats - 1) * p and own + p >= least and (end + 1 == n or words[end + 1] != words[end + 1 - p]):
                out.append((end - own - p + 1, own + p, p))
    return sorted(out)


def _of_texts(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[np.ndarray]]:
    """Runs of each text, and its words as numbers."""
    names = Words()
    each = [numbers(t, names) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in each])])
    words = np.concatenate(each) if each else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(each)), np.diff(starts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in candidates(words, text):
        k = int(text[a])
        shift = a - int(starts[k])
        found[k] += [(s + shift, n, p) for s, n, p in runs(words[a:b].tolist())]
    return [sorted(f) for f in found], each


def collapsed(text: bytes, count: int, found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only its first period."""
    if not found:
        return b" ".join(w for p in pieces(text) for w in p.split()) if count else b""
    keep = np.ones(count, bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    out, at = [], 0
    for p in pieces(text):
        words = p.split()
        out += [words[k] for k in np.flatnonzero(keep[at : at + len(words)]).tolist()]
        at += len(words)
    return b" ".join(out)


def with_runs(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The columns of carry, with n_words, runs (start, length, period; words count
    from 0; by start and period) and collapsed, the text with one period of each run."""
    clash = {"n_words", "runs", "collapsed", "_text"} & {c.lower() for c in carry}
    if clash:
        raise ValueError(f"results have the names {sorted(clash)}")
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("binary").alias("_text"))
    schema = StructType([f for f in rows.schema if f.name != "_text"])
    schema = schema.add("n_words", LongType()).add("runs", ArrayType(RUN)).add("collapsed", BinaryType())
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in RUN.names]))

    def run(batches):
        for part in chunks(batches):
            texts = [t or b"" for t in part.column(part.num_columns - 1).to_pylist()]
            found, words = _of_texts(texts)
            lists = [[dict(zip(RUN.names, r, strict=True)) for r in f] for f in found]
            short = [collapsed(t, len(w), f) for t, w, f in zip(texts, words, found, strict=True)]
            extra = [pa.array([len(w) for w in words], pa.int64()), pa.array(lists, kind), pa.array(short, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *extra], [*part.schema.names[:-1], "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
