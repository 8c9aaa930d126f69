"""Jaccard similarity join on word shingles by PartEnum signatures.

A text's set holds the 64-bit hashes of its distinct shingles. Two sets a, b with
a similarity of at least t percent differ in at most (100 - t) / (100 + t) *
(|a| + |b|) members. So:

* Sizes are cut into bands, wide enough that a partner of a set lies in its own
  band or the next. A band has a partition of the feature domain (the hash
  modulo its number of parts) into more parts than its sets can differ in. A set
  enumerates its parts for its own band and, if it can be the larger partner,
  for the band below. Similar sets agree in at least (parts - difference) parts;
  a signature is the content of a part. Empty parts have no signature.
* Sets of one signature are candidates: all pairs if it has at most MANY sets.
  A signature of more sets is hot and not paired. That loses nothing for a set
  with more other signatures than it can differ in: one of the parts it agrees
  in with a partner is not hot. The remaining sets, and those with too many
  empty parts, go the exact way of `hot_pairs`: shingles ranked by their
  frequency among these sets, rarest first; partners share one of the first
  |a| - t% |a| + 1. That is the enumeration with one feature a part.
* Candidates are thinned by two bounds that no similar pair fails, sizes and the
  distance of parity sketches (a bit flips for every differing member), and
  then checked on the full sets.

Texts of one set are one class; classes are linked, not their copies. A class is
named by a 64-bit hash of its set.

A null or empty text, or one without words, has the empty set and links with
nothing. Fewer words than a shingle are one shingle. Repeated rows have the same
component. A null doc_id is carried, but is never a component's id; its text links
like any other, and a component without any doc_id has none. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.components import components
from freshet.llm.shared import chunks, laid, mixed, written

WORDS = 5
PERCENT = 75
#: Lower end of a band over its upper end; at most t / 100.
BAND = 0.6
#: Parts over the largest difference: room for empty and hot parts.
SPARE = 1.15
#: Most sets of a signature whose pairs are all candidates.
MANY = 12
#: A side of a join up to so many rows (of two numbers) is broadcast.
BROADCAST_ROWS = 500_000
#: Texts are hashed in blocks of about so many bytes.
BLOCK = 1 << 20

_U = np.uint64


@lru_cache(maxsize=1)
def _gaps() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 32
    return out


def _blocks(raw: list[bytes]):
    """(number of the text, bytes): a long text in blocks that end at a gap."""
    for k, text in enumerate(raw):
        at = 0
        while len(text) - at > BLOCK:
            cut = max(text.rfind(g, at, at + BLOCK) for g in (b" ", b"\n"))
            if cut <= at:
                later = [text.find(g, at + BLOCK) for g in (b" ", b"\n")]
                cut = min((c for c in later if c >= 0), default=len(text))
            yield k, text[at:cut]
            at = cut
        yield k, text[at:]


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and where each text begins."""
    parts, per_text = [], np.zeros(len(raw), np.int64)
    owners: list[int] = []
    held: list[bytes] = []

    def hash_held():
        flat = _lower()[np.frombuffer(b" ".join(held), np.uint8)]
        gap = _gaps()[flat]
        begins = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]])) if len(flat) else np.zeros(0, np.int64)
        if len(begins):
            lead = np.append(begins, len(flat))
            inside = np.arange(lead[0], len(flat)) - np.repeat(begins, np.diff(lead))
            powers = np.cumprod(np.full(int(inside.max()) + 1, 0x9E3779B97F4A7C15, _U), dtype=_U)
            values = np.where(gap[lead[0] :], _U(0), flat[lead[0] :].astype(_U) + _U(1)) * powers[inside]
            parts.append(mixed(np.add.reduceat(values, begins - begins[0])))
        ends = np.cumsum([len(t) + 1 for t in held])
        np.add.at(per_text, owners, np.diff(np.searchsorted(begins, np.concatenate([[0], ends]))))

    size = 0
    for k, block in _blocks(raw):
        if held and size + len(block) > BLOCK:
            hash_held()
            held, owners, size = [], [], 0
        held.append(block)
        owners.append(k)
        size += len(block)
    if held:
        hash_held()
    return np.concatenate(parts) if parts else np.zeros(0, _U), np.concatenate([[0], np.cumsum(per_text)])


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    hashes, at = word_hashes([(t or "").encode("utf-8", "replace") for t in texts])
    if len(hashes) >= words:
        rolled = np.zeros(len(hashes) - words + 1, _U)
        for j in range(words):
            rolled = mixed(rolled + hashes[j : len(hashes) - words + 1 + j] + _U(j + 1))
    else:
        rolled = np.zeros(0, _U)
    out = []
    for k in range(len(texts)):
        a, b = int(at[k]), int(at[k + 1])
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            short = np.full(1, b - a, _U)
            for h in hashes[a:b]:
                short = mixed(short * _U(31) + h)
            out.append(short)
        else:
            out.append(np.zeros(0, _U))
    return out


class Bands:
    """Upper ends of the bands, numbers of parts, and the most that a set of a
    size can differ from a partner."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        ends = [1]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, int(ends[-1] / BAND)))
        self.ends = np.array(ends, np.int64)
        self.parts = (self.difference(self.ends, self.partner(self.ends)) * SPARE).astype(np.int64) + 2

    def partner(self, size):
        """The largest partner of a set."""
        return size * 100 // self.percent

    def difference(self, a, b):
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def needed(self, size):
        """The least overlap with any partner."""
        return -(-size * self.percent // 100)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, sizes)

    def enumerations(self, sizes: np.ndarray):
        """For the own band and the one below: (which sets, band, most difference)."""
        own = self.of(sizes)
        yield sizes > 0, own, self.difference(sizes, self.partner(sizes))
        below = np.maximum(own - 1, 0)
        larger = (sizes > 0) & (own > 0) & (self.needed(sizes) <= self.ends[below])
        yield larger, below, self.difference(sizes, self.ends[below])


def signatures(sets: list[np.ndarray], bands: Bands):
    """For each enumeration: (set, band, signature) arrays of all nonempty parts."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, _U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    spread, content = mixed(flat + _U(0x51)), mixed(flat ^ _U(0xA5A5A5A5))
    for used, band, most in bands.enumerations(sizes):
        pick = used[owner]
        who, b = owner[pick], band[owner[pick]]
        part = (spread[pick] % bands.parts[b].astype(_U)).astype(np.int64)
        order = np.argsort(who * np.int64(1 << 36) + part)
        who, part, b = who[order], part[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (part[1:] != part[:-1])])) if len(who) else who
        total = np.add.reduceat(content[pick][order], first) if len(first) else np.zeros(0, _U)
        tag = mixed((b[first].astype(_U) << _U(40)) + part[first].astype(_U))
        nonempty = np.bincount(who[first], minlength=len(sets))
        yield used, band, most, nonempty, who[first], mixed(total ^ tag)


def sketch(members: np.ndarray) -> bytes:
    """Parities of the members' counts in a power of two of cells, about two each."""
    cells = 64
    while cells < 2 * len(members):
        cells *= 2
    counts = np.bincount((mixed(members ^ _U(0x77)) & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(counts.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Differing parities: at most the number of differing members."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    n, m = len(a), len(b)
    while n > m:
        n //= 2
        x = (x >> 8 * n) ^ (x & ((1 << 8 * n) - 1))
    while m > n:
        m //= 2
        y = (y >> 8 * m) ^ (y & ((1 << 8 * m) - 1))
    return (x ^ y).bit_count()


def class_keys(sets: list[np.ndarray]) -> list[int]:
    """A signed 64-bit name of every set; that of the empty set is 0."""
    out = np.zeros(len(sets), _U)
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        sizes = np.array([len(sets[k]) for k in full])
        flat, first = np.concatenate([sets[k] for k in full]), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        one, two = (np.add.reduceat(mixed(flat ^ _U(c)), first) for c in (0x11, 0x2222))
        out[full] = mixed(one ^ mixed(two + sizes.astype(_U)))
    return out.view(np.int64).tolist()


SHINGLED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("own_parts", T.IntegerType()),
        T.StructField("below_parts", T.IntegerType()),
    ]
)


def shingled(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Size, class, sketch and numbers of nonempty parts of every row."""

    def run(batches):
        bands = Bands(percent)
        for batch in chunks(batches, BLOCK):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            own, below = ((used, nonempty) for used, _, _, nonempty, _, _ in signatures(sets, bands))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(class_keys(sets), pa.int64()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    pa.array(own[1].astype(np.int32)),
                    pa.array(below[1].astype(np.int32), mask=~below[0]),
                ],
                SHINGLED.names,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SHINGLED)


def signature_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(signature, key, band): band -1 for the single shingles of a set that has
    too many empty parts. A task sends each set once, however many copies it has."""

    def run(batches):
        bands, seen = Bands(percent), set()
        for batch in chunks(batches, BLOCK):
            sets, keys = [], []
            every = shingle_sets(batch.column(0).to_pylist(), words)
            for s, key in zip(every, class_keys(every), strict=True):
                if len(s) and key not in seen:
                    seen.add(key)
                    sets.append(s)
                    keys.append(key)
            if not sets:
                continue
            named = np.array(keys, np.int64)
            short = np.zeros(len(sets), bool)
            for used, band, most, nonempty, who, signature in signatures(sets, bands):
                short |= used & (nonempty <= most)
                yield _signature_batch(signature, named[who], band[who])
            for k in np.flatnonzero(short):
                s = sets[k]
                first = s[: len(s) - int(bands.needed(len(s))) + 1]
                yield _signature_batch(mixed(first ^ _U(0x3C3C)), np.full(len(first), named[k]), np.full(len(first), -1))

    return docs.select("text").mapInArrow(run, "signature long, key long, band int")


def _signature_batch(signature: np.ndarray, key: np.ndarray, band: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(signature.view(np.int64)), pa.array(key), pa.array(band.astype(np.int32))], ["signature", "key", "band"]
    )


def candidates(rows: DataFrame, many: int = MANY) -> DataFrame:
    """(a, b, band, n): pairs a < b of a signature of at most `many` sets (band
    null), and sets a with how many hot signatures in a band (b null)."""
    # One shuffle: rows of a signature come together, sorted, and are read in a stream.
    dealt = rows.repartition("signature").sortWithinPartitions("signature", "key")

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(k).cast(pa.int64()).to_numpy() for k in range(3)]))
            size += batch.num_rows
            if size < 1 << 17:
                continue
            rows = _once(np.concatenate(held, axis=1))
            # The last signature may go on in the next batch.
            cut = int(np.searchsorted(rows[0], rows[0, -1]))
            yield from _paired(rows[:, :cut], many)
            rows = rows[:, cut:]
            if rows.shape[1] > 1 << 16:
                # A hot signature is not held: as many sets stay as show that it is hot.
                yield _hot(rows[:, : -many - 1])
                rows = rows[:, -many - 1 :]
            held, size = [rows], rows.shape[1]
        if held:
            yield from _paired(_once(np.concatenate(held, axis=1)), many)

    return (
        dealt.mapInArrow(run, "a long, b long, band int, n long")
        .groupBy("a", "b", "band")
        .agg(F.sum("n").alias("n"))
    )


def _once(rows: np.ndarray) -> np.ndarray:
    """Without repeated (signature, key), which several tasks can send."""
    if not rows.shape[1]:
        return rows
    again = (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])
    return rows[:, np.concatenate([[True], ~again])]


def _paired(rows: np.ndarray, many: int):
    if not rows.shape[1]:
        return
    signature, key, band = rows
    first = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
    count = np.repeat(np.diff(np.append(first, len(signature))), np.diff(np.append(first, len(signature))))
    hot = count > many
    if hot.any():
        yield _hot(np.stack([signature[hot], key[hot], band[hot]]))
    few = (count > 1) & ~hot
    signature, key = signature[few], key[few]
    found = []
    for d in range(1, many):
        same = np.flatnonzero(signature[d:] == signature[:-d]) if len(signature) > d else np.zeros(0, np.int64)
        if not len(same):
            break
        found.append(np.stack([key[same], key[same + d]]))
    if found:
        pairs, n = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
        yield _counted(pairs[0], pairs[1], None, n)


def _hot(rows: np.ndarray) -> pa.RecordBatch:
    sets, n = np.unique(rows[1:], axis=1, return_counts=True)
    return _counted(sets[0], None, sets[1], n)


def _counted(a, b, band, n) -> pa.RecordBatch:
    none = np.ones(len(a), bool)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a),
            pa.array(b) if b is not None else pa.array(np.zeros(len(a), np.int64), mask=none),
            pa.array(band.astype(np.int32)) if band is not None else pa.array(np.zeros(len(a), np.int32), mask=none),
            pa.array(n.astype(np.int64)),
        ],
        ["a", "b", "band", "n"],
    )


def _alike(n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def close_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not rule out, with the distance
    of the sketches by the sets' sizes."""

    def side(name):
        return classes.select(F.col("key").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(_alike(F.col("n_a"), F.col("n_b"), percent))

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            a, b, n_a, n_b = (batch.column(k).to_numpy() for k in range(4))
            far = [sketch_distance(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            apart = np.array(far, np.int64)
            near = apart <= bands.difference(n_a, n_b)
            share = apart / np.maximum(n_a + n_b, 1)
            yield pa.RecordBatch.from_arrays([pa.array(x[near]) for x in (a, b, share)], ["a", "b", "apart"])

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long, apart double")


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, broadcast if it is counted and small."""
    return F.broadcast(df) if df.count() <= most else df


def member_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(key, members) of the classes in wanted (key, doc_id), a written table."""
    named = wanted.filter("doc_id is not null").select(F.col("key").alias("_key"), F.col("doc_id").alias("_id"))
    texts = docs.select("doc_id", "text").join(sized(named), F.col("doc_id").cast("long") == F.col("_id"))
    nameless = wanted.filter("doc_id is null").select("key")

    def run(batches):
        seen = set()
        for batch in chunks(batches, BLOCK):
            keys, sets = [], []
            every = shingle_sets(batch.column(1).to_pylist(), words)
            for want, s, key in zip(batch.column(0).to_pylist(), every, class_keys(every), strict=True):
                # A repeated id with another text is not the class asked for.
                if want not in seen and key == want:
                    seen.add(want)
                    keys.append(want)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "members"])

    def run_nameless(batches):
        seen = set()
        for batch in chunks(batches, BLOCK):
            every = shingle_sets(batch.column(0).to_pylist(), words)
            new = {key: s for key, s in zip(class_keys(every), every, strict=True) if len(s) and key not in seen}
            seen.update(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(new), pa.int64()), pa.array([s.tobytes() for s in new.values()], pa.binary())], ["key", "members"]
            )

    found = texts.select("_key", "text").mapInArrow(run, "key long, members binary")
    if nameless.isEmpty():
        return found
    # Classes that only rows without an id have: their sets are found by the class of the text.
    of_rows = docs.filter(F.col("doc_id").cast("long").isNull()).select("text").mapInArrow(run_nameless, "key long, members binary")
    return found.union(of_rows.join(sized(nameless), "key", "left_semi").dropDuplicates(["key"]))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a written table whose sets are similar, checked on all members.

    The set of a goes once to every 64 or so of its partners, in a stream of rows
    sorted by a, so neither a task nor its memory holds a group of pairs.
    """
    pairs = laid(pairs)
    lots = pairs.groupBy("a").agg(F.ceil(F.count("*") / 64).alias("lots"))
    spread = written(pairs.join(lots, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("lots")).alias("lot")))
    partners = sized(spread).join(sets, F.col("b") == F.col("key")).select("a", "lot", "b", "members")
    heads = sized(laid(spread).select("a", "lot").distinct()).join(sets, F.col("a") == F.col("key"))
    rows = partners.union(heads.select("a", "lot", F.lit(None).cast("long"), "members"))
    dealt = rows.repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first())

    def run(batches):
        head, group = None, None
        for batch in chunks(batches):
            found = []
            columns = (batch.column(k).to_pylist() for k in range(4))
            for a, lot, b, members in zip(*columns, strict=True):
                s = np.frombuffer(members, _U)
                if b is None:
                    head, group = s, (a, lot)
                    continue
                if group != (a, lot):
                    raise RuntimeError(f"no members of the set {a}")
                common = len(np.intersect1d(head, s, assume_unique=True))
                if 100 * common >= percent * (len(head) + len(s) - common):
                    found.append((a, b))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""

    def side(name):
        return labels.select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"))

    df = pairs.join(sized(side("a")), "a", "left").join(sized(side("b")), "b", "left")
    return df.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select(*pairs.columns)


class Linker:
    """Edges found so far. Unless every link is asked for, only pairs that could
    still join components are checked."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int, every: bool):
        self.docs, self.classes, self.words, self.percent, self.every = docs, classes, words, percent, every
        self.edges: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _checked(self, pairs: DataFrame) -> None:
        """pairs: a written table."""
        ends = written(laid(pairs).select(F.explode(F.array("a", "b")).alias("key")).distinct())
        wanted = written(sized(ends).join(self.classes.select("key", "doc_id"), "key"))
        sets = written(member_sets(self.docs, wanted, self.words))
        new = linked(pairs.select("a", "b"), sets, self.percent)
        self.edges = written(new if self.edges is None else self.edges.union(new))
        if not self.every:
            self.labels = written(components(self.edges))

    def add(self, pairs: DataFrame) -> None:
        """First each set's nearest partner by sketch, then all pairs still apart."""
        close = close_pairs(pairs, self.classes, self.percent)
        close = written(close if self.labels is None else _apart(close, self.labels))
        if close.isEmpty():
            return
        if self.every:
            new = close.select("a", "b").distinct()
            self._checked(written(new if self.edges is None else new.join(self.edges, ["a", "b"], "left_anti")))
            return
        best = laid(close).groupBy("b").agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", "b")
        best = written(best)
        self._checked(best)
        rest = written(_apart(laid(close), self.labels).join(sized(best), ["a", "b"], "left_anti"))
        if not rest.isEmpty():
            self._checked(rest)


def hot_pairs(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(feature, key, n, core, place): the shingles by which sets of hot
    signatures meet, rarest first.

    core: members that some other of these sets has too, a bound of any overlap.
    Sets with too small a core for any partner are left out, exactly.
    """

    def run(batches):
        for batch in chunks(batches, BLOCK):
            for key, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                feature = np.frombuffer(members, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(feature), key)), pa.array(feature)], ["key", "feature"])

    member = written(sets.mapInArrow(run, "key long, feature long"))
    shared = member.groupBy("feature").agg(F.count("*").alias("df")).filter("df > 1")
    held = member.join(shared, "feature").join(sizes, "key")
    per_set = held.groupBy("key").agg(
        F.first("n_shingles").alias("n"), F.sort_array(F.collect_list(F.struct("df", "feature"))).alias("members")
    )  # a group is one set
    needed = F.ceil(F.col("n") * percent / 100)
    core = per_set.withColumn("core", F.size("members").cast("long")).filter(F.col("core") >= needed)
    # Members that no other set has stand in front of the rest.
    first = F.slice("members", F.lit(1), (F.col("core") - needed + 1).cast("int"))
    return core.select("key", "n", "core", F.posexplode(first).alias("place", "m")).select(
        F.col("m.feature").alias("feature"), "key", "n", "core", "place"
    )


def _can_overlap(x: str, y: str, percent: int) -> Column:
    """No similar pair whose first common shingle this is fails: what follows it
    in either set must suffice."""
    left = F.least(F.col(f"{x}.core") - F.col(f"{x}.place"), F.col(f"{y}.core") - F.col(f"{y}.place"))
    n = F.col(f"{x}.n") + F.col(f"{y}.n")
    return (left * (100 + percent) >= percent * n) & _alike(F.col(f"{x}.n"), F.col(f"{y}.n"), percent)


def _linked(docs: DataFrame, words: int, percent: int, many: int, every: bool) -> tuple[DataFrame, Linker]:
    rows = written(shingled(docs, words, percent))
    classes = written(
        rows.filter("n_shingles > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            *(F.first(c).alias(c) for c in ("n_shingles", "sketch", "own_parts", "below_parts")),
        )
    )
    found = written(candidates(signature_rows(docs, words, percent), many))
    link = Linker(docs, classes, words, percent, every)
    link.add(found.filter("b is not null").select("a", "b"))
    _add_hot(link, found.filter("b is null").select(F.col("a").alias("key"), "band", "n"), percent)
    return rows, link


def grouped(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, many: int = MANY) -> DataFrame:
    """doc_id, n_shingles, key (the class), component_id, the smallest doc_id
    reachable by links, and component, its name among classes, per row of docs
    (doc_id, text)."""
    rows, link = _linked(docs, words, percent, many, every=False)
    named = rows.withColumn("_c", F.col("key"))
    if link.labels is not None:
        named = rows.join(sized(link.labels), F.col("key") == F.col("node"), "left")
        named = named.withColumn("_c", F.coalesce("component", "key")).drop("node", "component")
    lowest = named.filter("n_shingles > 0").groupBy(F.col("_c").alias("_k")).agg(F.min("doc_id").alias("_least"))
    out = named.join(lowest, (F.col("_c") == F.col("_k")) & (F.col("n_shingles") > 0), "left")
    reached = F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "key", reached.alias("component_id"), F.col("_c").alias("component"))


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, many: int = MANY) -> DataFrame:
    """doc_id, n_shingles, key and component_id of `grouped`."""
    return grouped(docs, words, percent, many).drop("component")


def with_class(docs: DataFrame, name: str, words: int = WORDS) -> DataFrame:
    """Adds the class of the text, null for the empty set."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index("text")

    def run(batches):
        for batch in chunks(batches, BLOCK):
            sets = shingle_sets(batch.column(at).to_pylist(), words)
            keys = [k if len(s) else None for k, s in zip(class_keys(sets), sets, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], schema.names)

    return docs.mapInArrow(run, schema)


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, many: int = MANY) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, (a, b) as class keys, and membership:
    (doc_id, n_shingles, key) per row. Its rows are as many as there are links."""
    rows, link = _linked(docs, words, percent, many, every=True)
    none = docs.sparkSession.createDataFrame([], "a long, b long")
    return none if link.edges is None else link.edges, rows.select("doc_id", "n_shingles", "key")


def _add_hot(link: Linker, hot: DataFrame, percent: int) -> None:
    bands = Bands(percent)
    n = F.col("n_shingles")
    # The own band has the size within its ends, else it is the band below.
    ends = F.array(*(F.lit(int(e)) for e in bands.ends))
    end = F.get(ends, F.col("band"))
    own = n <= end
    partner = F.floor(n * 100 / percent)
    most = F.floor((n + F.when(own, partner).otherwise(end)) * (100 - percent) / (100 + percent))
    parts = F.when(own, F.col("own_parts")).otherwise(F.col("below_parts"))
    # Strictly more other signatures than possible differences: nothing is lost.
    unsafe = (F.col("band") == -1) | (parts - F.col("n") <= most)
    exposed = written(hot.join(link.classes, "key").filter(unsafe).select("key", "doc_id", "n_shingles").distinct())
    if exposed.isEmpty():
        return
    sets = written(member_sets(link.docs, exposed.select("key", "doc_id"), link.words))
    rows = written(hot_pairs(sets, exposed.select("key", "n_shingles"), percent))
    # First every set against the fullest cores of its shingles, then what is still apart.
    hubs = rows.groupBy("feature", F.pmod(F.xxhash64("key"), F.lit(4)).alias("_lot")).agg(
        F.max(F.struct("core", "place", "key", "n")).alias("h")
    )
    hub = hubs.select("feature", "h.*")
    met = rows.alias("x").join(hub.alias("y"), "feature").filter(F.col("x.key") != F.col("y.key"))
    star = met.filter(_can_overlap("x", "y", percent)).select(
        F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")
    )
    link.add(star.distinct())
    component = F.col("key")
    if link.labels is not None:
        rows = rows.join(sized(link.labels), F.col("key") == F.col("node"), "left")
        component = F.coalesce("component", "key")
    placed = written(rows.select("feature", "key", "n", "core", "place", component.alias("c")))
    mixed_buckets = placed.groupBy("feature").agg(F.min("c").alias("_low"), F.max("c").alias("_high")).filter("_low <> _high")
    open_rows = written(placed.join(mixed_buckets.select("feature"), "feature"))
    met = open_rows.alias("x").join(
        open_rows.alias("y"),
        (F.col("x.feature") == F.col("y.feature"))
        & (F.col("x.key") < F.col("y.key"))
        & (F.col("x.c") != F.col("y.c"))
        & _can_overlap("x", "y", percent),
    )
    link.add(met.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())
