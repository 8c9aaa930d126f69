"""Upkeep of a published cube: only cells whose inputs changed are computed again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.digest import digest_diff
from freshet.operators.formula import formula_frame, formula_sums
from freshet.sources import editions
from freshet.steps import kept

KEYS = ["scenario", "year", "month"]
BY = ("scenario", "year")


def cells(inputs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(scenario, year, month, place, value)``: the sum of each place's nodes, missing
    where one of them is."""
    return formula_sums(inputs, terms, keys=KEYS).select(*KEYS, "place", F.col("num").alias("value"))


def changed_cells(old: DataFrame, new: DataFrame, terms: DataFrame) -> DataFrame:
    """``(scenario, year, month, place)`` of cells that a changed input goes into."""
    inputs = digest_diff(old, new, [*KEYS, "node"], ["flow_cfs"])
    return inputs.join(terms.select("node", "place").distinct(), "node").select(*KEYS, "place").distinct()


def revise_slice(spark: SparkSession, root: str, cube: str, inputs: str, since: int, terms: Sequence[tuple]) -> list[str]:
    """Brings a published cube up to date with its inputs; the partitions replaced.

    ``inputs(scenario, year, month, node, flow_cfs)`` and ``cube(scenario, year, month,
    place, value)`` are published by scenario and year; ``since`` is the edition of the
    inputs that the cube was made of. Partitions that no run wrote since are told by
    the editions and not read. In the others digests find the rows that changed, the
    terms lead from their nodes and months to cells, and only these are computed, from
    the rows of their places' nodes in their months. A cell without rows goes. One
    edition replaces the partitions in which a cell changed.
    """
    parts = editions.changed_parts(spark, root, inputs, since)
    if not parts:
        return []
    sides = []
    for edition in (since, None):
        there = [p for p in parts if p in editions.places(spark, root, edition)[inputs]]
        sides.append(editions.lookup(spark, root, inputs, edition=edition, parts=there) if there else None)
    # A partition may be new or gone.
    old, new = (side if side is not None else other.limit(0) for side, other in (sides, sides[::-1]))
    frame = formula_frame(spark, terms)
    stale = kept(changed_cells(old, new, frame))
    hit = {(r["scenario"], r["year"]) for r in stale.select(*BY).distinct().collect()}
    published = editions.places(spark, root)[cube]

    def among(names) -> list[str]:
        split = ((p, editions.values(spark, p)) for p in names)
        return sorted(p for p, v in split if (v["scenario"], int(v["year"])) in hit)

    if not hit:
        return []
    wanted = stale.join(frame.select("node", "place").distinct(), "place").select(*KEYS, "node").distinct()
    rows = new.join(wanted, [*KEYS, "node"], "left_semi")
    again = cells(rows, frame).join(stale, [*KEYS, "place"], "left_semi")
    here = among(published)
    if here:
        rest = editions.lookup(spark, root, cube, parts=here).join(stale, [*KEYS, "place"], "left_anti")
        again = rest.select(*again.columns).unionByName(again)
    with editions.draft(spark, root) as draft:
        draft.drop(cube, here)
        draft.write(cube, again, BY)
    return sorted(draft.changes[cube])
