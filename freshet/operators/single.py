"""One value per key, checked: a repeated key fails instead of losing a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPEATED = "several rows where one is expected: "

#: Marks of up to so many members are bits of one number.
BITS = 63


def refuse(repeated: Column, what: str, otherwise: Column) -> Column:
    """``otherwise``, or an error where ``repeated`` holds."""
    return F.when(repeated, F.raise_error(F.lit(REPEATED + what))).otherwise(otherwise)


def only(value: Column, where: Column, what: str = "value") -> Column:
    """Aggregate: the value of the one row with ``where``; missing without such a row."""
    return refuse(F.count(F.when(where, 1)) > 1, what, F.max(F.when(where, value)))


def one_row(df: DataFrame, keys: Sequence[str], what: str = "key") -> DataFrame:
    """The rows of ``df``, one per ``keys``; a repeated key is an error.

    Rows are counted before the shuffle, so a key that holds much of the data
    fails without being gathered.
    """
    rest = [c for c in df.columns if c not in keys]
    row = refuse(F.count(F.lit(1)) > 1, what, F.max(F.struct(*rest)))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*keys, *(F.col(f"__row.`{c}`").alias(c) for c in rest))


def repeated_marks(mark: Column, rows: Column) -> Column:
    """Aggregate: whether a one-bit mark occurs more than once among ``rows`` rows."""
    return rows > F.bit_count(F.coalesce(F.bit_or(mark), F.lit(0).cast("long")))


def position_mark(column: Column, names: Sequence) -> Column:
    """The bit of a value's place in a short list; missing for other values."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), column)
    return F.when(place > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int")))
