"""Best-fit packing of token sequences by linear grouping.

A document's tokens (with an end token) are one piece, or, if longer than the
capacity, pieces of the capacity and a shorter last one. What is packed is the
histogram of piece lengths, at most one number per length, so the plan costs
the same for any number of documents:

1. Linear grouping: the lengths that are not small are sorted and cut into groups
   of equal cardinality; each is rounded up to the longest of its group.
2. The few rounded sizes are packed by configurations (which sizes share a
   sequence, and how many sequences do): column generation over the linear
   programme, rounded down.
3. Actual lengths take the places of their group's size, longest first.
4. All that is left, and all small lengths, longest first, go into the fullest
   sequences that still have room (best fit), else into new ones.

A few numbers of groups and bounds of `small` are planned; the fewest sequences win.

Sequences of equal content are one run with a count. The plan maps a length and
a rank among the pieces of that length to a sequence and an offset. Ranks come
from per-partition counts, so no task sees all pieces of a length.

Null text is empty; an empty text is its end token alone. Repeated rows are
packed each on its own; a null doc_id is carried. Extra columns are dropped. An
empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.shared import chunks, written

CAPACITY = 4096
END_ID = 1
#: Plans that are tried: numbers of groups, and the share of the capacity up to
#: which lengths are small.
TRIES = ((8, 1 / 4), (24, 1 / 4), (16, 1 / 2))
#: Words kept with their ids in a Python worker, and the bytes of both.
CACHED = 400_000
CACHED_BYTES = 32 << 20

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
)

#: Letters followed by marks that the tokenizer keeps apart from them.
_MARKED = re.compile(r"(.+?)([!-&(-/:-@\[-`{-~]*)", re.S)
#: Letters below this are lower-cased alike everywhere.
_LATIN_END = "\u0250"


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte (fixed by the byte-level format)."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


class WordIds:
    """Ids of whole texts as little-endian bytes, looked up by word.

    The tokenizer drops white space and joins nothing across it, so a text's
    ids are those of its words. A word of Latin letters, with or without marks
    behind it, is one run of letters (and one of marks): its lower case goes to
    the merges directly. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.as_letters = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.held = 0

    def _letters(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            plain = word if word.isascii() else word.encode().decode("latin-1").translate(self.as_letters)
            ids = self.known[word] = array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()
        return ids

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def learn(self, words: set[str]) -> None:
        known = self.known
        for word in words:
            base, marks = (word, "") if word.isalpha() else _MARKED.fullmatch(word).groups()
            lower = base.lower()
            if base.isalpha() and lower.isalpha() and max(base) < _LATIN_END and is_normalized("NFC", lower):
                if marks and marks not in known:
                    known[marks] = self._whole(marks)
                known[word] = self._letters(lower) + known[marks]
            else:
                known[word] = self._whole(word)
        self.held += sum(len(w) + len(known[w]) for w in words)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED or self.held > CACHED_BYTES:
            self.known, self.held = {"": b""}, 0
        split, known = [t.replace("\n", " ").split(" ") for t in texts], self.known
        self.learn({w for words in split for w in words if w not in known})
        look = known.__getitem__
        return [b"".join(map(look, words)) for words in split]


@lru_cache(maxsize=1)
def _words(path: str) -> WordIds:
    """One per Python worker, so that later tasks find the words of earlier ones."""
    return WordIds(path)


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every text, with the partition and the rank among the pieces
    of the same length in it. Call `written` before using the ranks."""

    def run(batches):
        words, seen = _words(path), defaultdict(int)
        part = TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        for batch in chunks(batches, 4 << 20):
            out = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    n = len(cut) // 4
                    out.append((doc_id, piece, at // 4, n, zlib.crc32(cut), part, seen[n]))
                    seen[n] += 1
            columns = [pa.array(c, f) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, PIECE.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def linear_groups(counts: np.ndarray, least: int, groups: int) -> list[list[tuple[int, int]]]:
    """Groups of equal cardinality of the lengths over least, longest first, each
    as (length, how many), longest first. Pieces of one length can be in several
    groups; groups of one and the same longest length are joined."""
    lengths = [(n, int(counts[n])) for n in range(len(counts) - 1, least, -1) if counts[n]]
    share = max(1, -(-sum(c for _, c in lengths) // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for n, count in lengths:
        while count:
            if not room:
                room = share
                if not out or out[-1][0][0] != n:
                    out.append([])
            used = min(count, room)
            if out[-1] and out[-1][-1][0] == n:
                out[-1][-1] = (n, out[-1][-1][1] + used)
            else:
                out[-1].append((n, used))
            count, room = count - used, room - used
    return out


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of most worth: an unbounded knapsack."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fit = np.flatnonzero(sizes <= room)
        if len(fit):
            values = best[room - sizes[fit]] + worth[fit]
            k = int(values.argmax())
            if values[k] > best[room] + 1e-12:
                best[room], choice[room] = values[k], fit[k]
    config, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            config[choice[room]] += 1
            room -= sizes[choice[room]]
    return best[capacity], config


def configurations(sizes: list[int], need: list[int], capacity: int, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """How many sequences have which numbers of each size (none over the need).

    The linear programme `fewest sequences that hold all` by the revised simplex
    method with generated columns, rounded down: what is left over is the
    caller's.
    """
    if not sizes:
        return []
    size, demand, m = np.array(sizes), np.array(need, float), len(sizes)
    basis = np.diag((capacity // size).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        amount = inverse @ demand
        worth, column = _best_configuration(size, np.maximum(np.ones(m) @ inverse, 0), capacity)
        if worth <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratios = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(ratios.argmin())] = column
    amount = np.floor(np.linalg.solve(basis, demand) + 1e-6)
    out, left = [], np.array(need)
    for j in np.argsort(-(basis * size[:, None]).sum(0)):
        config = basis[:, j].astype(int)
        used = config > 0
        times = int(min(max(amount[j], 0), (left[used] // config[used]).min()))
        if times:
            left -= times * config
            out.append((times, config))
    return out


class Runs:
    """Runs of equal sequences: how many, and the lengths in each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, times: int, lengths: tuple[int, ...]) -> None:
        room = self.capacity - sum(lengths)
        if not self.by_room[room]:
            heapq.heappush(self.rooms, room)
        self.by_room[room].append((times, lengths))

    def best_fit(self, length: int, count: int) -> None:
        """Each of count pieces goes to a sequence with the least room that holds it."""
        while count:
            room = min((r for r in self.rooms if r >= length and self.by_room[r]), default=None)
            if room is None:
                break
            times, lengths = self.by_room[room].pop()
            fits = room // length
            # Best fit fills one sequence until another has less room for it: the same.
            full = min(times, count // fits)
            if full:
                self.add(full, lengths + (length,) * fits)
                count -= full * fits
            if times > full and count:
                self.add(1, lengths + (length,) * count)
                count, times = 0, times - 1
            if times > full:
                self.add(times - full, lengths)
        fits = self.capacity // length
        if count >= fits:
            self.add(count // fits, (length,) * fits)
        if count % fits:
            self.add(1, (length,) * (count % fits))

    def all(self):
        for runs in self.by_room.values():
            yield from runs


def plan(counts: np.ndarray, capacity: int = CAPACITY, tries=TRIES) -> list[tuple[int, tuple[int, ...]]]:
    """Runs (how many sequences, lengths in each) that hold counts[n] pieces of
    every length n exactly: the plan of fewest sequences of those tried."""
    plans = (_plan(counts, capacity, groups, small) for groups, small in tries)
    return min(plans, key=lambda runs: sum(times for times, _ in runs))


def _plan(counts: np.ndarray, capacity: int, groups: int, small: float) -> list[tuple[int, tuple[int, ...]]]:
    left = np.array(counts, dtype=object)
    runs = Runs(capacity)
    grouped = linear_groups(left, int(capacity * small), groups)
    members = [[list(m) for m in g] for g in grouped]
    taken = configurations([g[0][0] for g in grouped], [sum(c for _, c in g) for g in grouped], capacity)
    for times, config in taken:
        slots = [g for g, n in enumerate(config) for _ in range(n)]
        each = {g: slots.count(g) for g in slots}
        while times:
            # As many equal sequences as the longest length left in every group
            # allows; a group whose longest has too few for one gives two lengths.
            same = times
            for g, n in each.items():
                same = min(same, max(1, members[g][0][1] // n))
            lengths = []
            for g in slots:
                first = next(m for m in members[g] if m[1] >= same)
                first[1] -= same
                left[first[0]] -= same
                lengths.append(first[0])
            for g in each:
                members[g] = [m for m in members[g] if m[1]]
            runs.add(same, tuple(lengths))
            times -= same
    for n in range(len(left) - 1, 0, -1):
        if left[n]:
            runs.best_fit(n, int(left[n]))
    return list(runs.all())


def places(runs: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks with the sequence of the first and the
    offset, in the order of (length, first rank)."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for times, lengths in runs:
        offset = 0
        for n in lengths:
            rows.append((n, rank[n], sequence, offset))
            rank[n] += times
            offset += n
        sequence += times
    rows.sort()
    return {k: np.array(v, np.int64) for k, v in zip(("length", "rank", "sequence", "offset"), zip(*rows, strict=True), strict=True)}


PLACED = T.StructType([*PIECE.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, tries=TRIES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    spark = docs.sparkSession
    pieces = written(tokenized(docs, path, capacity, end_id))
    # At most one row per length, whatever the number of pieces.
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    totals = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    if not totals:
        return spark.createDataFrame([], PLACED)
    counts = np.zeros(capacity + 1, dtype=object)
    for r in totals:
        counts[r["length"]] = r["n"]
    # Its size is bounded by the lengths and groups, not by the documents.
    at = places(plan(counts, capacity, tries))
    # The key joins length and rank; a rank is far below 2 ** 48.
    keys = (at["length"] << 48) + at["rank"]
    sequence, offset, first = at["sequence"], at["offset"], at["rank"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    ranked = pieces.join(starts, ["part", "length"]).select(
        *PIECE.names[:5], (F.col("rank") + F.col("ranks_before")).alias("rank")
    )

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            k = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            found = [pa.array(sequence[k] + rank - first[k]), pa.array(offset[k])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], PLACED.names)

    return ranked.mapInArrow(place, PLACED)
