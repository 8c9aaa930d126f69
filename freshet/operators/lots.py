"""Rows dealt to lots of bounded size, so that the memory of a task does not grow with the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Rows of a lot, about: an aggregate of so many groups takes some hundred megabytes at most.
PER_LOT = 250_000


def deal(rows: DataFrame, keys: Sequence[str], n_rows: int) -> DataFrame:
    """Rows with equal ``keys`` in one of so many lots that each holds about ``PER_LOT`` of ``n_rows``.

    Lots are never fewer than the session's shuffle partitions, and aggregates by ``keys`` and
    further columns need no other shuffle. For groups that are about as many as the rows, which
    nothing combines before a shuffle; rows of a large group meet in one task, which streams them.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-n_rows // PER_LOT)), *keys)
