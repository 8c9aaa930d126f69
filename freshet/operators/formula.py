"""Node formulas as data.

A formula is a set of rows ``(metric, place, role, node, weight)``. Evaluating
all formulas of all metrics is one join and one grouped sum, however many
places there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.missing import PLAIN, RatioPolicy, quotient, settle
from freshet.operators.lookup import small_frame
from freshet.operators.single import BITS, refuse, repeated_marks

KEYS = ("scenario", "date")
TERM = "metric string, place string, role string, node string, weight double, n_terms long, mark long, own long, bits boolean"


def marked(rows: Sequence[tuple], *group: int) -> list[tuple]:
    """Rows with a bit of their own within the group of rows that agree in some places."""
    seen: Counter = Counter()
    out = []
    for row in rows:
        key = tuple(row[g] for g in group)
        if seen[key] == BITS:
            raise ValueError(f"more than {BITS} members of {key}; pass them as a DataFrame")
        out.append((*row, 1 << seen[key]))
        seen[key] += 1
    return out


def repeated_over(mark: str, window) -> Column:
    """Whether a mark occurs more than once in a window."""
    return F.count(mark).over(window) > F.bit_count(F.bit_or(mark).over(window))


def formula_frame(spark: SparkSession, terms: Sequence[tuple]) -> DataFrame:
    """Literal terms ``(metric, place, role, node[, weight])`` as a broadcast dimension."""
    full = [(*t, 1.0) if len(t) == 4 else tuple(t) for t in terms]
    counts = Counter(t[:3] for t in full)
    rows = [(*t[:4], float(t[4]), counts[t[:3]], t[5], (1 << counts[t[:3]]) - 1, True) for t in marked(full, 0, 1, 2)]
    return small_frame(spark, rows, TERM)


def with_term_counts(terms: DataFrame) -> DataFrame:
    """The same for a formula table: add the number of terms of each formula, and
    hashes as marks, as the terms may be more than bits."""
    key = ["metric", "place", "role"]
    hashed = terms.withColumns({"mark": F.xxhash64("node"), "bits": F.lit(False)})
    counts = hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("n_terms"), F.bit_xor("mark").alias("own"))
    return hashed.join(counts, key)


def formula_sums(
    flows: DataFrame,
    formulas: DataFrame,
    roles: Sequence[str] = ("num",),
    keys: Sequence[str] = KEYS,
    strict: bool = True,
    value: str = "flow_cfs",
) -> DataFrame:
    """Weighted sums per (keys, metric, place), one column per role.

    ``strict``: one missing node makes the sum missing (column arithmetic);
    otherwise the nodes that are present are summed. Nodes are compared by their
    marks, not counted. A node with several rows is an error; in a formula table,
    whose marks are hashes, it is found once there are as many rows as terms, and
    until then a strict sum is missing. Flows that ``lots.deal`` dealt by ``keys`` are
    not shuffled again, and a task holds the sums of its lot.
    """
    joined = flows.join(formulas, "node")
    columns = []
    for role in roles:
        here = F.col("role") == role
        total = F.sum(F.when(here, F.col("weight") * F.col(value)))
        mark = F.when(here, F.col("mark"))
        rows, wanted, own = F.count(mark), F.max(F.when(here, F.col("n_terms"))), F.max(F.when(here, F.col("own")))
        bits = F.max(F.when(here, F.col("bits")))
        known = F.when(bits, repeated_marks(mark, rows)).otherwise(
            (rows > wanted) | ((rows == wanted) & (F.bit_xor(mark) != own))
        )
        present = F.bit_xor(F.when(F.col(value).isNotNull(), mark)) == own
        complete = present & (F.count(F.when(here, F.col(value))) == wanted)
        columns.append(refuse(known, "node", F.when(complete, total) if strict else total).alias(role))
    return joined.groupBy(*keys, "metric", "place").agg(*columns)


def by_place(place: str, default: Column, special: Mapping[str, Column]) -> Column:
    """A column expression that differs for a few places."""
    out = default
    for name, expr in special.items():
        out = F.when(F.col(place) == name, expr).otherwise(out)
    return out


def formula_ratio(
    flows: DataFrame,
    formulas: DataFrame,
    policy: RatioPolicy = PLAIN,
    exceptions: Mapping[str, RatioPolicy] | None = None,
    keys: Sequence[str] = KEYS,
    strict: bool = True,
) -> DataFrame:
    """Numerator over denominator per (keys, metric, place) under a policy."""
    sums = formula_sums(flows, formulas, ("num", "den"), keys, strict)
    special = {p: settle("__x", rule) for p, rule in (exceptions or {}).items()}
    # The quotient is a column of its own: every branch of the rules reads it.
    shares = sums.withColumn("__x", quotient("num", "den"))
    return shares.withColumn("value", by_place("place", settle("__x", policy), special)).drop("__x")


def apportion(
    flows: DataFrame,
    members: Sequence[tuple[str, str, str, str]],
    keys: Sequence[str] = KEYS,
    value: str = "flow_cfs",
) -> DataFrame:
    """Split a shared node over the places it serves, by their own flow.

    ``members``: ``(group, place, own node, shared node)``. A place whose own
    flow is 0 gets 0; one missing own flow or a missing shared flow makes the
    group missing; several rows of a node in a month are an error. A window holds one group of one month, so its length is that
    of the literal member list.
    """
    own = [(g, p, n) for g, p, n, _ in members]
    shared = [(g, None, s) for g, s in sorted({(g, s) for g, _, _, s in members})]
    sizes = Counter(g for g, _, _ in own)
    dim = small_frame(
        flows.sparkSession,
        marked([(*r, sizes[r[0]]) for r in own + shared], 0),
        "share_group string, place string, node string, n_members long, mark long",
    )
    group = Window.partitionBy(*keys, "share_group")
    mine = F.when(F.col("place").isNotNull(), F.col(value))
    total = F.when(F.count(mine).over(group) == F.col("n_members"), F.sum(mine).over(group))
    rows = (
        flows.join(dim, "node")
        .withColumn("own", mine)
        .withColumn("total", refuse(repeated_over("mark", group), "node", total))
        .withColumn("shared", F.max(F.when(F.col("place").isNull(), F.col(value))).over(group))
        .filter(F.col("place").isNotNull())
    )
    part = F.when(F.col("own") == 0, F.lit(0.0)).otherwise(quotient("own", "total") * F.col("shared"))
    return rows.withColumn("value", part).select(*keys, "place", "own", "total", "shared", "value")
