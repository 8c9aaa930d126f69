"""Wide and long forms of the same series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.dates import in_years
from freshet.operators.single import BITS, position_mark, refuse, repeated_marks


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    names_to: str = "node",
    values_to: str = "flow_cfs",
) -> DataFrame:
    """One row per (ids, column); rows with a missing value are kept."""
    if columns is None:
        columns = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), list(columns), names_to, values_to)


def to_wide(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    values_from: str,
    names: Sequence,
    prefix: str = "",
) -> DataFrame:
    """One column per listed name.

    Written as conditional aggregates, which need one shuffle on ``keys`` and
    combine before it; a pivot shuffles on (keys, name) first and then on keys.
    Several rows of one cell are an error.
    """
    cells, names = [], list(names)
    for first in range(0, len(names), BITS):
        part = names[first : first + BITS]
        mark = position_mark(F.col(names_from), part)
        repeated = repeated_marks(mark, F.count(mark))
        for n in part:
            cell = F.max(F.when(F.col(names_from) == F.lit(n), F.col(values_from)))
            cells.append(refuse(repeated, "cell", cell).alias(f"{prefix}{n}"))
    return df.groupBy(*keys).agg(*cells)


def month_year_matrix(
    df: DataFrame,
    value: str,
    years: Sequence[int],
    keys: Sequence[str] = ("scenario",),
    date: str = "date",
) -> DataFrame:
    """Twelve rows per key, one column ``y<year>`` per year."""
    cells = _of_years(df, years, date).select(*keys, F.month(date).alias("month"), F.year(date).alias("year"), F.col(value))
    return to_wide(cells, [*keys, "month"], "year", value, years, "y")


def _of_years(df: DataFrame, years: Sequence[int], date: str) -> DataFrame:
    """Rows of the years; of consecutive ones by two bounds of the date, which reach a scan."""
    years = list(years)
    if years and years == list(range(years[0], years[-1] + 1)):
        return df.filter(in_years(date, years[0], years[-1]))
    return df.filter(F.year(date).isin(years))


def year_month_matrix(
    df: DataFrame,
    value: str,
    years: Sequence[int],
    keys: Sequence[str] = ("scenario",),
    date: str = "date",
) -> DataFrame:
    """The transpose: one row per year, one column ``m<month>`` per month."""
    cells = _of_years(df, years, date).select(*keys, F.month(date).alias("month"), F.year(date).alias("year"), F.col(value))
    return to_wide(cells, [*keys, "year"], "month", value, range(1, 13), "m")


def split_list(df: DataFrame, column: str, out: str, separator: str = ",") -> DataFrame:
    """One row per element of a separated list; blanks and ``NA`` are dropped."""
    parts = F.transform(F.split(F.col(column), separator), lambda c: F.trim(c))
    return df.withColumn(out, F.explode(parts)).filter((F.col(out) != "") & (F.col(out) != "NA"))


def take_prefix(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Keep the keys and the columns that start with ``prefix``, without it."""
    chosen = [F.col(f"`{c}`").alias(c[len(prefix):]) for c in df.columns if c.startswith(prefix)]
    return df.select(*keys, *chosen)


def mutate(df: DataFrame, steps: Sequence[tuple[str, Column | str]]) -> DataFrame:
    """Computed columns in order; a later step sees the columns of earlier ones."""
    for name, expr in steps:
        df = df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)
    return df


def fill_missing(df: DataFrame, value: float = 0.0, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL (and NaN) in numeric columns."""
    return df.fillna(value, subset=list(columns)) if columns else df.fillna(value)


def union_named(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column one frame lacks is missing there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_rules(df: DataFrame, parts: Sequence[tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """Stack parts of one frame, ``(which rows, columns to add or replace)``, in one scan.

    A row appears once for each part that it is of; a column one part lacks is missing
    there. A frame column of the same name keeps its value in parts that do not name it.
    """
    added = list(dict.fromkeys(name for _, columns in parts for name in columns))
    names = [*df.columns, *(n for n in added if n not in df.columns)]
    wanted = F.lit(False)
    for rows, _ in parts:
        wanted = wanted | rows

    def row(columns: Mapping[str, Column]) -> Column:
        own = {c: F.col(f"`{c}`") for c in df.columns} | dict(columns)
        return F.struct(*(own.get(n, F.lit(None)).alias(n) for n in names))

    copies = F.filter(F.array(*(F.when(rows, row(columns)) for rows, columns in parts)), lambda r: r.isNotNull())
    stacked = df.filter(wanted).select(F.explode(copies).alias("__row"))
    return stacked.select(*(F.col(f"__row.`{n}`").alias(n) for n in names))
