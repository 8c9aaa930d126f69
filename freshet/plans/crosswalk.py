"""Node maps of the two model families side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.lookup import full_merge, small_frame
from freshet.plans import maps

SCHEMA = "place string, nodes string"
PRODUCTS = ("flows", "diversions", "bypass", "delta", "routing")


def _sides(product: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    if product == "diversions":
        shared = [
            (place, f"{own} / ({' + '.join(r[2] for r in maps.SHARED_2 if r[0] == group)}) * {node}")
            for group, place, own, node in maps.SHARED_2
        ]
        older = [(r[0], " + ".join(maps.nodes(r[1]))) for r in maps.DIVERSIONS_2] + shared
        return older, [(r[0], " + ".join(maps.nodes(r[1]))) for r in maps.DIVERSIONS_3]
    rows, name, c = {
        "flows": (maps.FLOW_NODES, 0, 1),
        "bypass": (maps.BYPASS_SEGMENTS, 1, 2),
        "delta": (maps.DELTA_NODES, 0, 1),
        "routing": (maps.MATRIX_NODES, 0, 1),
    }[product]
    return tuple(
        [(r[name], " + ".join(maps.nodes(r[k]))) for r in rows if r[k]] for k in (c, c + 1)
    )


def crosswalk(spark: SparkSession, product: str) -> DataFrame:
    """``(place, calsim2, calsim3)``: the formula of each place in both families."""
    older, newer = (small_frame(spark, side, SCHEMA) for side in _sides(product))
    both = full_merge(older, newer, ["place"])
    return both.select("place", F.col("nodes_x").alias("calsim2"), F.col("nodes_y").alias("calsim3"))
