"""Dense place x month x year cubes, kept in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from freshet.functions.dates import in_years
from freshet.operators.lots import deal
from freshet.operators.single import one_row, only
from freshet.operators.skew import year_list

KEYS = ("scenario",)


def grid(places: DataFrame, scenarios: Sequence[str], first: int, last: int) -> DataFrame:
    """Every (scenario, place, month, year) cell, by exploding literal ranges."""
    return (
        places.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in scenarios])))
        .withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    )


def model_cube(
    series: DataFrame,
    places: Sequence[str],
    first: int,
    last: int,
    fill: float | bool | None = None,
    value: str = "value",
    keys: Sequence[str] = KEYS,
    date: str = "date",
) -> DataFrame:
    """Complete a series to ``len(places) * 12 * years`` cells per key.

    Values are combined to cells before their shuffle. The keys of the cells, read
    from the same shuffle, and the literal places and months give an empty seed for
    every cell; a second aggregate, of cells only, lays them together. Several rows
    of one cell are an error. Places that are not listed are left out, and where
    missing values are filled NaN counts as missing.
    """
    chosen = series.filter(in_years(date, first, last) & F.col("place").isin(list(places)))
    cells = _cells(chosen, [*keys, "place"], first, value, date)
    # The count keeps both uses of the cells alike, so that one shuffle serves both.
    present = cells.groupBy(*keys).agg(F.count("value").alias("__n")).filter("__n >= 0")
    seeds = present.select(*keys, F.explode(F.array(*[F.lit(p) for p in places])).alias("place"))
    dense = _dense(cells, seeds, [*keys, "place"], first, last, fill, series.schema[value].dataType)
    order = F.array_position(F.array(*[F.lit(p) for p in places]), F.col("place")).cast("int")
    return dense.select(*keys, order.alias("place_order"), "place", "month", "year", "value")


def _cells(series: DataFrame, keys: Sequence[str], first: int, value: str, date: str) -> DataFrame:
    """One row per (keys, cell), the cell being the month counted from January of ``first``."""
    cell = ((F.year(date) - first) * 12 + F.month(date) - 1).alias("cell")
    rows = series.select(*keys, cell, F.col(value).alias("value"))
    return rows.groupBy(*keys, "cell").agg(only(F.col("value"), F.lit(True), "cell").alias("value"))


def _dense(
    cells: DataFrame, seeds: DataFrame, keys: Sequence[str], first: int, last: int, fill: float | bool | None, kind: DataType
) -> DataFrame:
    """All months of the seeds' keys; cells of other keys are left out."""
    empty = seeds.select(*keys, _months(first, last).alias("cell"), F.lit(None).cast(kind).alias("value"), F.lit(True).alias("__seed"))
    both = cells.select(*keys, "cell", "value", F.lit(False).alias("__seed")).unionByName(empty)
    rows = both.groupBy(*keys, "cell").agg(F.max("value").alias("value"), F.max("__seed").alias("__seed")).filter("__seed")
    return _filled(rows, keys, first, fill, kind)


def _months(first: int, last: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit((last - first + 1) * 12 - 1)))


def _filled(rows: DataFrame, keys: Sequence[str], first: int, fill: float | bool | None, kind: DataType) -> DataFrame:
    found = F.col("value")
    if fill is not None:
        known = F.nanvl(found, F.lit(None).cast(kind)) if isinstance(kind, (DoubleType, FloatType)) else found
        found = F.coalesce(known, F.lit(fill))
    return rows.select(
        *keys,
        (F.col("cell") % 12 + 1).cast("int").alias("month"),
        (F.floor(F.col("cell") / 12) + first).cast("int").alias("year"),
        found.alias("value"),
    )


def table_cube(
    series: DataFrame,
    places: DataFrame,
    scenarios: Sequence[str],
    first: int,
    last: int,
    fill: float | None = None,
    value: str = "value",
    date: str = "date",
) -> DataFrame:
    """The same for a place table that grows, and given scenarios.

    Every (scenario, place) of the grid contributes its empty cells; places and
    scenarios that are not in it are left out. Rows of the series and places are dealt to
    lots of about as many cells each, whatever the places are; the empty cells are made there and
    not before. Several rows of one cell are an error.
    """
    keys, kind = ["scenario", "place"], series.schema[value].dataType
    seeds = places.select("place", F.explode(F.array(*[F.lit(s) for s in scenarios])).alias("scenario"))
    chosen = series.filter(in_years(date, first, last) & F.col("scenario").isin(list(scenarios)))
    cell = ((F.year(date) - first) * 12 + F.month(date) - 1).alias("cell")
    given = chosen.select(*keys, F.array(cell).alias("cells"), F.col(value).alias("value"), F.lit(False).alias("__seed"))
    months = (last - first + 1) * 12
    empty = seeds.select(*keys, F.lit(None).cast("array<int>").alias("cells"), F.lit(None).cast(kind).alias("value"), F.lit(True).alias("__seed"))
    dealt = deal(given.unionByName(empty), keys, places.count() * len(scenarios) * months)
    cells = F.coalesce("cells", F.sequence(F.lit(0), F.lit(months - 1)))
    both = dealt.select(*keys, F.explode(cells).alias("cell"), "value", "__seed")
    found = only(F.col("value"), ~F.col("__seed"), "cell").alias("value")
    rows = both.groupBy(*keys, "cell").agg(found, F.max("__seed").alias("__seed")).filter("__seed")
    return _filled(rows, keys, first, fill, kind).select("scenario", "place", "month", "year", "value")


def nest(cube: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (keys, place) with ``values[month][year]``.

    A place has twelve values per year, so the gathered array is short.
    """
    ordered = F.sort_array(F.collect_list(F.struct("month", "year", "value")))
    rows = cube.groupBy(*keys, "place").agg(ordered.alias("cells"), F.min("year").alias("first_year"))
    n_years = (F.size("cells") / 12).cast("int")
    months = F.transform(
        F.sequence(F.lit(0), F.lit(11)),
        lambda m: F.transform(F.slice("cells", m * n_years + 1, n_years), lambda c: c["value"]),
    )
    return rows.select(*keys, "place", "first_year", months.alias("values"))


def unnest(nested: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Nested arrays back to one row per cell."""
    months = nested.select(*keys, "place", "first_year", F.posexplode("values").alias("m", "row"))
    cells = months.select(*keys, "place", "first_year", "m", F.posexplode("row").alias("y", "value"))
    return cells.select(
        *keys,
        "place",
        (F.col("m") + 1).alias("month"),
        (F.col("first_year") + F.col("y")).alias("year"),
        "value",
    )


def completeness(cube: DataFrame, n_places: int, n_years: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Cell counts per key against ``places * 12 * years``, and missing values."""
    cells = cube.groupBy(*keys, "place", "month", "year").agg(
        F.count(F.lit(1)).alias("copies"), F.count("value").alias("filled")
    )
    return (
        cells.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_cells"),
            F.sum(F.when(F.col("copies") > 1, 1).otherwise(0)).alias("n_duplicated"),
            F.sum(F.when(F.col("filled") == 0, 1).otherwise(0)).alias("n_missing"),
        )
        .withColumn("n_expected", F.lit(n_places * 12 * n_years).cast("long"))
        .withColumn("complete", (F.col("n_cells") == F.col("n_expected")) & (F.col("n_duplicated") == 0))
    )


def override_slice(
    cube: DataFrame, source: DataFrame, place: str, keys: Sequence[str] = KEYS, value: str = "value"
) -> DataFrame:
    """Replace one place's cells by ``source(keys, year, month, value)``.

    A cell the source lacks becomes missing; several rows for one cell are an
    error. One join over one scan of the cube.
    """
    on = [*keys, "year", "month"]
    source = one_row(source.select(*on, value, F.col("year").alias("__year"), F.col("month").alias("__month")), on, "month")
    if not keys:
        # Calendar months bound these rows: twelve for each year up to 9999. The aggregated columns
        # keep the bound and the join's conditions above the scan, which stays the same as that of the cube.
        source = F.broadcast(source.filter(F.col("__year").between(1, 9999) & F.col("__month").between(1, 12)))
    months = [F.col("__year").alias("year"), F.col("__month").alias("month")]
    new = source.select(*keys, *months, F.lit(place).alias("place"), F.col(value).alias("__new"))
    taken = F.when(F.col("place") == place, F.col("__new")).otherwise(F.col("value"))
    return cube.join(new, [*on, "place"], "left").withColumn("value", taken).select(*cube.columns)


def splice_years(base: DataFrame, other: DataFrame, years: DataFrame) -> DataFrame:
    """Cells of ``other`` in the listed years, of ``base`` in all others."""
    key = year_list(years)
    return other.join(key, "year", "left_semi").select(*base.columns).unionByName(
        base.join(key, "year", "left_anti").select(*base.columns)
    )


def override_months(rules: DataFrame, values: Mapping[int, float], column: str) -> DataFrame:
    """Fixed values for some months of a rule table."""
    out = F.col(column)
    for month, value in values.items():
        out = F.when(F.col("month") == month, F.lit(value)).otherwise(out)
    return rules.withColumn(column, out)
