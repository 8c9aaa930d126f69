"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the smallest
distance. A table has FUNCTIONS hashes floor((a . x + b) / width) with normal a;
its bucket is all of them together. A query visits its own bucket of every table
and then perturbed ones, a hash one up or down, in the order of estimated
success: the sum of the squared distances to the borders that would have to be
crossed. The candidates of all tables are merged and ranked by exact cosine.

Functions a table, their width and the number of buckets visited are fitted: of
SETTINGS and PROBES with a recall of at least RECALL on a bounded sample of vectors,
whose neighbours are farther and so harder to find than those among all vectors, the
ones that meet fewest. If none has that recall all queries are compared with all
vectors, a block of queries at a time. Every vector is indexed.

Buckets are put together in groups of a bounded size by their names' hash. A vector
and a query are sent once to a group, with the list of their buckets in it.

Of equal vectors the k + 1 smallest ids are indexed: no query can return others.
A bucket with more than LOT vectors is dealt to several tasks, and its probes to
all of them. A query that finds fewer than k is compared with all vectors.

Takes no part: a null id, a null or zero vector, null or non-finite components,
a dimension other than the most frequent one (the larger of equally frequent).
Equal (id, vector) rows are one. Ties go to the smaller id. Fewer candidates than
k: all are returned. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.shared import mixed, written

TABLES = 8
#: Functions a table and width; the first are taken where probes are given.
SETTINGS = ((8, 2.0), (4, 1.0), (6, 2.0), (8, 1.0), (12, 2.0))
PROBES = (16, 32, 64, 96, 128, 192, 256)
RECALL = 0.97
SAMPLE = 2000
SAMPLE_QUERIES = 200
#: Queries that compare the settings; the others of the sample confirm the choice.
SETTING_QUERIES = 40
LOT = 4096
#: Components of the vectors of a group of buckets.
GROUP_NUMBERS = 1 << 20
#: Queries compared with all vectors at a time.
BLOCK = 4096
SEED = 5

FOUND = "query_id long, vec_id long, score double"


class Hashes:
    """The hash functions of all tables for vectors of one dimension."""

    def __init__(self, dimension: int, tables: int = TABLES, functions: int = SETTINGS[0][0], width: float = SETTINGS[0][1], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tables, self.functions, self.width = tables, functions, width
        self.a = rng.normal(size=(dimension, tables * functions))
        self.b = rng.uniform(0, width, tables * functions)
        self.odd = rng.integers(1, 1 << 63, tables * functions, dtype=np.uint64) | np.uint64(1)
        self.names = np.arange(tables, dtype=np.uint64) << np.uint64(56)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, tables, functions): whole cells, and the place in them from 0 to width."""
        at = (x @ self.a + self.b).reshape(len(x), self.tables, self.functions)
        whole = np.floor(at / self.width)
        return whole.astype(np.int64), at - whole * self.width

    def raw(self, whole: np.ndarray) -> np.ndarray:
        odd = self.odd.reshape(self.tables, self.functions)
        return (whole.astype(np.uint64) * odd).sum(2, dtype=np.uint64) + self.names

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(n, tables) names of buckets."""
        return mixed(self.raw(self.cells(x)[0])).view(np.int64)

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """(n, tables, count) names of the buckets to visit, best first; a table
        with fewer perturbed buckets repeats its own."""
        whole, place = self.cells(x)
        own = self.raw(whole)
        odd = self.odd.reshape(self.tables, self.functions).tolist()
        out = np.repeat(own[:, :, None], count, axis=2)
        for i in range(len(x)):
            for t in range(self.tables):
                start = int(own[i, t])
                for k, step in enumerate(perturbations(place[i, t], self.width, count - 1)):
                    moved = start + sum(odd[t][f] if up else -odd[t][f] for f, up in step)
                    out[i, t, k + 1] = moved % (1 << 64)
        return mixed(out).view(np.int64)


def perturbations(place: np.ndarray, width: float, count: int):
    """Sets of (function, up) in the order of their summed squared distances.

    The cheapest set not seen yet grows in two ways: its last move is replaced by
    the next dearer one, or that one is added. Moves of one function both up and
    down are passed over.
    """
    moves = sorted([(float(p) ** 2, f, False) for f, p in enumerate(place)] + [((width - float(p)) ** 2, f, True) for f, p in enumerate(place)])
    heap = [(moves[0][0], (0,))]
    while heap and count > 0:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(heap, (cost - moves[last][0] + moves[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + moves[last + 1][0], (*chosen, last + 1)))
        functions = [moves[c][1] for c in chosen]
        if len(set(functions)) == len(functions):
            count -= 1
            yield [moves[c][1:] for c in chosen]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of a with rows of b; equal rows give equal values wherever they stand."""
    length = np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1))
    return (a * b).sum(1) / length


def nearest(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, met: np.ndarray | None = None):
    """(query, row of x) pairs that hold every query's k nearest of the rows it met, ties included."""
    scores = unit(queries) @ unit(x).T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if met is not None:
        scores[~met] = -np.inf
    if len(ids) > k:
        # Rounding here may order near ties differently; they all go on.
        least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] - 1e-9
    else:
        least = np.full(len(queries), -2.0)
    return np.nonzero((scores >= least[:, None]) & np.isfinite(scores))


def visits(hashes: Hashes, x: np.ndarray, queries: int) -> np.ndarray:
    """(queries, rows of x): the first probe of any table, from 0, by which a query meets a row."""
    buckets, visited = hashes.buckets(x), hashes.probes(x[:queries], PROBES[-1])
    first = np.full((queries, len(x)), PROBES[-1])
    for t in range(hashes.tables):
        for q in range(queries):
            names, at = np.unique(visited[q, t], return_index=True)
            place = np.minimum(np.searchsorted(names, buckets[:, t]), len(names) - 1)
            first[q] = np.where(names[place] == buckets[:, t], np.minimum(first[q], at[place]), first[q])
    return first


def fitted(x: np.ndarray, k: int, wanted: float) -> tuple[Hashes, int] | None:
    """The functions and the number of probes that meet fewest of the rows of x at the
    wanted recall, None if no setting has it."""
    if len(x) <= k + 1:
        return Hashes(x.shape[1]), PROBES[0]
    x = unit(x)
    queries = min(len(x), SAMPLE_QUERIES)
    scores = x[:queries] @ x.T
    scores[np.arange(queries), np.arange(queries)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]

    def least(hashes: Hashes, n: int) -> tuple[float, int] | None:
        first = visits(hashes, x, n)
        found = np.take_along_axis(first, best[:n], 1)
        count = next((p for p in PROBES if (found < p).mean() >= wanted), None)
        # Work of a query: rows met, and buckets looked up.
        return None if count is None else ((first < count).sum() / n + count * hashes.tables, count)

    few = min(queries, SETTING_QUERIES)
    tried = [(least(h, few), h) for h in (Hashes(x.shape[1], functions=f, width=w) for f, w in SETTINGS)]
    for _, hashes in sorted(((at[0], h) for at, h in tried if at), key=lambda t: t[0]):
        if at := least(hashes, queries):
            return hashes, at[1]
    return None


def _vectors(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & fine)
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.size("v") == (top["size"] if top else -1)).dropDuplicates(["id", "v"])


class Held:
    """The vectors of a group, and by bucket which of them are in it."""

    def __init__(self, dimension: int):
        self.x, self.ids = np.zeros((0, dimension)), np.zeros(0, np.int64)
        self.buckets, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, x: np.ndarray, ids: np.ndarray, buckets: np.ndarray, sizes: np.ndarray) -> None:
        rows = np.repeat(np.arange(len(ids)) + len(self.ids), sizes)
        self.x, self.ids = np.concatenate([self.x, x]), np.concatenate([self.ids, ids])
        buckets, rows = np.concatenate([self.buckets, buckets]), np.concatenate([self.rows, rows])
        order = np.argsort(buckets, kind="stable")
        self.buckets, self.rows = buckets[order], rows[order]

    def met(self, buckets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(queries, vectors): whether they share one of the queries' buckets."""
        low, high = (np.searchsorted(self.buckets, buckets, side) for side in ("left", "right"))
        n = high - low
        places = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        out = np.zeros((len(sizes), len(self.ids)), bool)
        out[np.repeat(np.repeat(np.arange(len(sizes)), sizes), n), self.rows[places]] = True
        return out


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row.

    is_query: a condition on the column `id`.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, vec_id, embedding))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = _vectors(sample.column("v").combine_chunks())
    dimension = some.shape[1]
    chosen = (Hashes(dimension), probes) if probes else fitted(some, k, RECALL)

    copies = Window.partitionBy("v").orderBy("id")
    index = rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k + 1).drop("_copy")
    queries = rows.filter(is_query)
    if chosen is None:
        found = _against_all(written(queries), index, k)
        return top(spark.createDataFrame([], FOUND) if found is None else found, k)
    hashes, count = chosen

    def hashed(visit: int):
        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    x = unit(_vectors(part.column(1)))
                    names = hashes.probes(x, visit) if visit > 1 else hashes.buckets(x)[:, :, None]
                    flat = names.reshape(len(x), -1)
                    # A bucket is visited once.
                    lists = [np.unique(f) for f in flat]
                    row = np.repeat(np.arange(len(x)), [len(f) for f in lists])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(lists)), part.column(0).take(pa.array(row))], ["bucket", "id"]
                    )

        return run

    stored = written(index.mapInArrow(hashed(1), "bucket long, id long"))
    asked = queries.mapInArrow(hashed(count), "bucket long, id long")
    sizes = written(stored.groupBy("bucket").agg(F.count("*").alias("n")))
    entries = max(1, GROUP_NUMBERS // dimension)
    groups = -(-(sizes.agg(F.sum("n")).first()[0] or 0) // entries) or 1
    # A bucket that is too large for one task is a group of its own, dealt to lots; the others share groups.
    lots = sizes.select(
        "bucket",
        F.ceil(F.col("n") / LOT).cast("long").alias("lots"),
        F.when(F.col("n") <= LOT, F.pmod(F.col("bucket"), F.lit(groups))).otherwise(F.col("bucket")).alias("group"),
        (F.col("n") > LOT).alias("large"),
    )
    kept = stored.join(lots, "bucket").select("group", "large", F.pmod(F.xxhash64("id"), F.col("lots")).alias("lot"), "bucket", "id")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1))
    sent = asked.join(lots, "bucket").select("group", "large", every.alias("lot"), "bucket", "id")

    def parcels(part: DataFrame, vectors: DataFrame, kind: int) -> DataFrame:
        once = part.groupBy("group", "large", "lot", "id").agg(F.collect_list("bucket").alias("buckets"))
        return once.join(vectors, "id").select("group", "large", "lot", F.lit(kind).alias("kind"), "id", "buckets", "v")

    met = parcels(kept, index, 0).union(parcels(sent, queries, 1))
    dealt = met.repartition("group", "large", "lot").sortWithinPartitions("group", "large", "lot", "kind")

    def rank(batches):
        name, held = None, Held(dimension)
        for batch in batches:
            group, lot, kind, ids = (batch.column(c).to_numpy() for c in (0, 2, 3, 4))
            large = batch.column(1).to_numpy(zero_copy_only=False)
            x, lists = _vectors(batch.column(6)), batch.column(5)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat = lists.flatten().to_numpy()
            changed = (group[1:] != group[:-1]) | (lot[1:] != lot[:-1]) | (large[1:] != large[:-1])
            new = np.flatnonzero(np.concatenate([[True], changed]))
            out = []
            for a, b in zip(new, np.append(new[1:], len(ids)), strict=True):
                if (group[a], large[a], lot[a]) != name:
                    name, held = (group[a], large[a], lot[a]), Held(dimension)
                split = a + int(np.searchsorted(kind[a:b], 1))
                if split > a:
                    held.add(x[a:split], ids[a:split], flat[ends[a] : ends[split]], np.diff(ends[a : split + 1]))
                for c in range(split, b, 256):
                    d = min(b, c + 256)
                    seen = held.met(flat[ends[c] : ends[d]], np.diff(ends[c : d + 1]))
                    q, r = nearest(x[c:d], ids[c:d], held.x, held.ids, k, seen)
                    out.append((ids[c:d][q], held.ids[r], cosines(x[c:d][q], held.x[r])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    found = written(top(dealt.mapInArrow(rank, FOUND), k))
    lacking = queries.join(found.filter(F.col("rank") == k), F.col("id") == F.col("query_id"), "left_anti")
    rest = _against_all(written(lacking), index, k)
    return found if rest is None else top(found.select("query_id", "vec_id", "score").union(rest), k)


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query, merged over tables."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _against_all(queries: DataFrame, index: DataFrame, k: int) -> DataFrame | None:
    """Exact pairs for the queries that found fewer than k, a block of them at a time."""
    if queries.isEmpty():
        return None
    numbered = queries.withColumn("_block", F.floor((F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")) - 1) / (BLOCK // 64)))
    numbered = written(numbered)
    parts = []
    for row in numbered.select("_block").distinct().orderBy("_block").toLocalIterator():
        block = numbered.filter(F.col("_block") == row[0]).select("id", "v").toArrow()
        ids, x = block.column("id").to_numpy(), _vectors(block.column("v").combine_chunks())

        def compare(batches, ids=ids, x=x):
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    own, y = part.column(0).to_numpy(), _vectors(part.column(1))
                    q, r = nearest(x, ids, y, own, k)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[q], own[r], cosines(x[q], y[r]))], ["query_id", "vec_id", "score"])

        parts.append(written(top(index.select("id", "v").mapInArrow(compare, FOUND), k).select("query_id", "vec_id", "score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
