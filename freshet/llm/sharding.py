"""Consistent sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size, offset + j * skip, both from hashes of its name. The shards take turns, each
claiming the first slot of its order that is free, until the table is full: all
have the same number of slots, give or take one, and when a shard is added or
removed few slots change hands. A key's hash modulo the size names its slot: one
look in a table that is broadcast, whatever the number of keys.

The table has a row for each slot, at most MAX_SLOTS, so its broadcast is bounded.
The same key always has the same shard, a null key and a repeated row too (a null
is a key of its own). No shards, or more than slots, is an error. All other columns
of the rows are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.shared import fresh

SLOTS = 65_537
MAX_SLOTS = 1 << 20


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preferences(shard: str, slots: int) -> tuple[int, int]:
    """(offset, skip) of a shard's permutation of the slots."""
    return xxhash.xxh64_intdigest(shard, 1) % slots, xxhash.xxh64_intdigest(shard, 2) % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """For every slot the place of its shard in `shards`, sorted by name for the turns."""
    if not is_prime(slots) or slots > MAX_SLOTS:
        raise ValueError(f"slots must be a prime up to {MAX_SLOTS}")
    if not shards or len(shards) > slots or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least and no more than slots")
    table = np.full(slots, -1, np.int32)
    order = sorted(range(len(shards)), key=lambda k: shards[k])
    at = [preferences(shards[k], slots) for k in order]
    here, skip = [a for a, _ in at], [s for _, s in at]
    taken = bytearray(slots)
    left = slots
    while left:
        for turn, k in enumerate(order):
            slot = here[turn]
            while taken[slot]:
                slot = (slot + skip[turn]) % slots
            taken[slot], table[slot] = 1, k
            here[turn] = (slot + skip[turn]) % slots
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) rows of the lookup table."""
    names = pa.array(list(shards)).take(pa.array(lookup_table(shards, slots)))
    return spark.createDataFrame(pa.table({"slot": pa.array(np.arange(slots, dtype=np.int32)), "shard": names}))


def place(rows: DataFrame, key: Column, shards: Sequence[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """The rows with their slot and shard, which replace columns of those names."""
    placed = rows.withColumn(slot, slot_of(key, slots)).drop(shard)
    (look,) = fresh(placed, "table_slot")
    table = table_frame(rows.sparkSession, shards, slots).toDF(look, shard)
    return placed.join(F.broadcast(table), placed[slot] == table[look]).select(*placed.columns, shard)


def write_shards(placed: DataFrame, path: str, files: int = 8, shard: str = "shard", spread_by: str = "slot") -> None:
    """One folder a shard, of up to `files` files: a shard is no single task's."""
    lot = F.pmod(F.xxhash64(spread_by), F.lit(files))
    placed.repartition(F.col(shard), lot).write.partitionBy(shard).parquet(path)
