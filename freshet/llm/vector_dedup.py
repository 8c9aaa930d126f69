"""Near duplicates of embeddings by spherical k-means cells.

Vectors of one label are assigned to the cell of the centroid with the largest
cosine, and compared within cells by blocked products. A link may also cross the
border of two cells. Let d be the distance of unit vectors at the threshold. If x
of cell c and y of cell e are at most d apart, their distances to the plane
halfway between the centroids of c and e sum to d at most, so one of them is at
most d / 2 from it: a vector this near to a border also visits the cell beyond,
and no link is lost however the centroids lie. Where both visit, the pair counts
in the smaller cell.

Centroids are fitted by Lloyd rounds on a bounded sample: at most SAMPLE_NUMBERS
components, SAMPLE_EACH vectors a cell. A label of n vectors has sqrt(n) / 2 cells,
fewer if that passes the bound; every vector is assigned. Labels beyond the
MAX_LABELS largest, and those under LEAST vectors, are one cell.

Equal vectors of a label are compared once, with their number. Cells are dealt to
lots of about LOT vectors and every two lots meet in a task of their own; a task
returns sums of links and a spanning forest, never the pairs.

Null label, null, zero or non-finite vectors, or a null id: the row links with
nothing. Vectors of different dimension are not compared. Equal rows (id, label,
vector) are one; rows that share an id share its component. Other columns are
ignored. A vector without links is its own component. An empty table gives no
rows. Vectors may have any length; one has to fit in a task some times.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from freshet.llm.components import components
from freshet.llm.shared import written
from freshet.operators.skew import spread_join

THRESHOLD = 0.98
MAX_LABELS = 1024
LEAST = 32
SAMPLE_EACH = 16
SAMPLE_NUMBERS = 1 << 22
ROUNDS = 8
LOT = 1024
#: Slack of border tests, far over rounding.
SLACK = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centroids(x: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means of unit vectors: at most count unit centroids, no two equal."""
    c = np.unique(x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)], axis=0)
    for _ in range(rounds):
        scores = x @ c.T
        own = scores.argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        length = np.sqrt((sums * sums).sum(axis=1))
        bare = np.flatnonzero(length < 1e-9)
        far = scores[np.arange(len(x)), own].argsort(kind="stable")[: len(bare)]
        c = np.where(length[:, None] < 1e-9, 0, sums / np.maximum(length, 1e-9)[:, None])
        # A cell that nothing came to starts again at the vectors worst off.
        c[bare[: len(far)]] = x[far]
        c = np.unique(c[(c * c).sum(axis=1) > 0.5], axis=0)
    return c


def cells(x: np.ndarray, c: np.ndarray, distance: float) -> tuple[np.ndarray, np.ndarray]:
    """Each row's cell, and (rows, cells) of the visits beyond borders."""
    scores = x @ c.T
    own = scores.argmax(axis=1)
    between = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
    reach = (distance / 2 + SLACK) * between[own] + SLACK
    near = scores[np.arange(len(x)), own][:, None] - scores <= reach
    near[np.arange(len(x)), own] = False
    return own, near


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of a and b, unit vectors, have the cosine; values at the border
    are summed once more, so that the block they come in does not matter."""
    scores = a @ b.T
    for i, j in zip(*np.nonzero(np.abs(scores - threshold) < 1e-9), strict=True):
        scores[i, j] = math.fsum(a[i] * b[j])
    return scores >= threshold


def forest(p: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """The smallest row reachable from each of n rows over the pairs (p, q)."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[p], low[q])
        new = low.copy()
        np.minimum.at(new, p, least)
        np.minimum.at(new, q, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _codebooks(classes: DataFrame) -> dict:
    """(label, dimension) -> centroids, for labels with several cells."""
    spark = classes.sparkSession
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST)
    top = sizes.orderBy(F.desc("n"), "label", "dim").limit(MAX_LABELS).collect()
    count = {(r["label"], r["dim"]): math.ceil(math.sqrt(r["n"]) / 2) for r in top}
    numbers = sum(k * dim * SAMPLE_EACH for (_, dim), k in count.items())
    share = min(1.0, SAMPLE_NUMBERS / max(1, numbers))
    count = {g: k for g, m in count.items() if (k := int(m * share)) > 1}
    if not count:
        return {}
    size = {(r["label"], r["dim"]): r["n"] for r in top}
    rates = [(label, dim, int(min(1.0, SAMPLE_EACH * k / size[label, dim]) * 2**20)) for (label, dim), k in count.items()]
    chosen = classes.join(F.broadcast(spark.createDataFrame(rates, "label string, dim int, rate int")), ["label", "dim"])
    chosen = chosen.filter(F.pmod(F.xxhash64("v"), F.lit(2**20)) < F.col("rate")).select("label", "dim", "id", "v")
    sample = chosen.toArrow().combine_chunks().sort_by("id")
    labels, dims = sample.column("label").to_pylist(), sample.column("dim").to_pylist()
    rows: dict = {}
    for i, g in enumerate(zip(labels, dims, strict=True)):
        rows.setdefault(g, []).append(i)
    v = _one(sample.column("v"))
    return {g: centroids(unit(_matrix(v.take(pa.array(at)))), count[g]) for g, at in rows.items()}


def _assigned(classes: DataFrame, books: dict, distance: float, kind: str) -> DataFrame:
    """A row for each class in its cell, and one for each cell it visits."""
    sent = classes.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        known = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                groups: dict = {}
                for i, g in enumerate(zip(part.column("label").to_pylist(), part.column("dim").to_pylist(), strict=True)):
                    groups.setdefault(g, []).append(i)
                row, cell, own, visits = [], [], [], []
                for g, rows in groups.items():
                    if g in known:
                        mine, near = cells(unit(_matrix(part.column("v").take(pa.array(rows)))), known[g], distance)
                    else:
                        mine, near = np.zeros(len(rows), np.int64), np.zeros((len(rows), 1), bool)
                    for k, i in enumerate(rows):
                        there = np.flatnonzero(near[k]).tolist()
                        for c in (int(mine[k]), *there):
                            row.append(i)
                            cell.append(c)
                            own.append(int(mine[k]))
                            visits.append(there)
                out = part.take(pa.array(row))
                extra = [pa.array(cell, pa.int32()), pa.array(own, pa.int32()), pa.array(visits, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*out.columns, *extra], [*out.schema.names, "cell", "own", "visits"])

    return classes.mapInArrow(run, f"label string, dim int, v {kind}, id long, copies long, key long, cell int, own int, visits array<int>")


def _met(assigned: DataFrame) -> DataFrame:
    """Rows once for every pair of lots that they meet in: i asks, j is held.

    side: 0 asks, 1 is held, 2 both. Lots of visitors are numbered from -1 down.
    """
    member = F.col("cell") == F.col("own")
    sizes = assigned.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count_if(member) / LOT).cast("int").alias("lots"), F.ceil(F.count_if(~member) / LOT).cast("int").alias("strange")
    )
    rows = spread_join(assigned, sizes, ["label", "dim", "cell"], ["key"])
    lot = F.pmod(F.xxhash64("key"), F.greatest(F.when(member, F.col("lots")).otherwise(F.col("strange")), F.lit(1))).cast("int")
    rows = rows.withColumn("lot", lot)
    upto = "if({n} > 0, sequence(0, {n} - 1), array())"
    place = "named_struct('i', {i}, 'j', {j}, 'side', {side})"
    asked = f"transform(sequence(lot, lots - 1), x -> {place.format(i='lot', j='x', side='if(x = lot, 2, 0)')})"
    held = f"transform({upto.format(n='lot')}, x -> {place.format(i='x', j='lot', side='1')})"
    strange = f"transform({upto.format(n='strange')}, x -> {place.format(i='-1 - x', j='lot', side='1')})"
    visit = f"transform({upto.format(n='lots')}, x -> {place.format(i='-1 - lot', j='x', side='0')})"
    places = F.expr(f"if(cell = own, concat({asked}, {held}, {strange}), {visit})")
    return rows.select("label", "dim", "cell", "own", "visits", "id", "key", "copies", "v", F.inline(places))


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("key", "ascending")])
        side, ids, keys, copies, own = (table.column(c).to_numpy() for c in ("side", "id", "key", "copies", "own"))
        x, cell = unit(_matrix(_one(table.column("v")))), table.column("cell")[0].as_py()
        a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        links = np.zeros(len(ids), np.int64)
        if not len(a) or not len(b):
            p = q = np.zeros(0, np.int64)
        else:
            pairs = linked(x[a], x[b], threshold)
            if side[a[0]] == 2:
                np.fill_diagonal(pairs, False)
                links[a] = pairs @ copies[b]
            else:
                # Where both visit each other's cell, the pair counts in the smaller one.
                visits = table.column("visits").to_pylist()
                back = [k for k in np.unique(own[a]).tolist() if k < cell]
                for k in back:
                    both = np.array([k in visits[j] for j in b])
                    pairs[np.ix_(own[a] == k, both)] = False
                links[a] = pairs @ copies[b]
                links[b] = copies[a] @ pairs
            p, q = np.nonzero(pairs)
            p, q = a[p], b[q]
        some = np.flatnonzero(links)
        root = ids[forest(p, q, len(ids))]
        return pa.table({"key": keys[some], "id": ids[some], "links": links[some], "root": root[some]})

    return run


def near_groups(
    vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector.

    n_links: other vectors of the label with at least the cosine; component_id:
    the smallest id reachable over links; kept: whether that is the row's own id.
    """
    single = isinstance(kind := vectors.schema[embedding].dataType, ArrayType) and isinstance(kind.elementType, FloatType)
    kind = "array<float>" if single else "array<double>"
    v = F.col(embedding).cast(kind)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    fine = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), v.alias("v"), fine.alias("fine")
    ).distinct()
    part = rows.filter("fine")
    classes = part.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # Numbered once and then read as written, so that the numbers stay.
    classes = written(classes.select("label", F.size("v").alias("dim"), "v", "id", "copies", F.monotonically_increasing_id().alias("key")))
    distance = math.sqrt(2 - 2 * threshold)
    assigned = written(_assigned(classes, _codebooks(classes), distance, kind))
    met = _met(assigned).groupBy("label", "dim", "cell", "i", "j")
    found = written(met.applyInArrow(_compare(threshold), "key long, id long, links long, root long"))
    sums = found.groupBy("key").agg(F.sum("links").alias("links"))
    ties = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    near = classes.join(sums, "key", "left").join(ties, F.col("id") == F.col("node"), "left").select(
        "label",
        "v",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    back = spread_join(part, near, ["label", "v"], ["id"]).select("id", "n_links", "component_id")
    alone = rows.filter("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return back.union(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
