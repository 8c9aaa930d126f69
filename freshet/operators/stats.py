"""Grouped statistics of monthly series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.dates import in_months, in_years, month_end_of
from freshet.functions.distribution import student_p
from freshet.functions.missing import (
    PULSE_KEEP,
    RatioPolicy,
    ratio,
    strict_max,
    strict_mean,
    strict_median,
    strict_min,
    strict_sd,
    strict_sum,
)
from freshet.functions.units import acre_feet

KEYS = ("scenario",)


def _complete(agg: Column, value: str, expected: int | None) -> Column:
    """Require a number of values, for long frames that leave missing rows out."""
    return agg if expected is None else F.when(F.count(value) == expected, agg)


def monthly_sum(df: DataFrame, keys: Sequence[str], value: str = "flow_cfs", date: str = "date") -> DataFrame:
    return df.groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month")).agg(
        strict_sum(value).alias(value)
    )


def seasonal_mean(
    df: DataFrame,
    months: Sequence[int],
    first: int,
    last: int,
    keys: Sequence[str] = KEYS,
    value: str = "flow_cfs",
    date: str = "date",
    complete: bool = False,
) -> DataFrame:
    """Mean over some months of each year, missing if one of them is.

    ``complete`` also counts an absent row as missing.
    """
    chosen = df.filter(in_years(date, first, last) & in_months(date, months))
    mean = _complete(strict_mean(value), value, len(months) if complete else None)
    return chosen.groupBy(*keys, "place", F.year(date).alias("year")).agg(mean.alias("value"))


def monthly_median(
    df: DataFrame,
    first: int,
    last: int,
    keys: Sequence[str] = KEYS,
    value: str = "flow_cfs",
    date: str = "date",
    complete: bool = False,
) -> DataFrame:
    """Median over the years of each calendar month."""
    median = _complete(strict_median(value), value, last - first + 1 if complete else None)
    return (
        df.filter(in_years(date, first, last))
        .groupBy(*keys, "place", F.month(date).alias("month"))
        .agg(median.alias("value"))
    )


def pulse_ratio(
    df: DataFrame,
    first: int,
    last: int,
    policy: RatioPolicy = PULSE_KEEP,
    keys: Sequence[str] = KEYS,
    value: str = "flow_cfs",
    date: str = "date",
    complete: bool = False,
) -> DataFrame:
    """Standard deviation over median over 100, per place and calendar month."""
    years = last - first + 1 if complete else None
    stats = (
        df.filter(in_years(date, first, last))
        .groupBy(*keys, "place", F.month(date).alias("month"))
        .agg(
            _complete(strict_sd(value), value, years).alias("sd"),
            _complete(strict_median(value), value, years).alias("median"),
        )
    )
    # The division by 100 keeps NaN and the infinities, so the policy sees them.
    return stats.withColumn("value", ratio(F.col("sd") / 100, "median", policy))


def place_summary(df: DataFrame, keys: Sequence[str] = KEYS, value: str = "flow_cfs") -> DataFrame:
    return df.groupBy(*keys, "place").agg(
        strict_mean(value).alias("mean_flow"),
        strict_min(value).alias("min_flow"),
        strict_max(value).alias("max_flow"),
    )


def daily_to_monthly_mean(
    df: DataFrame, keys: Sequence[str], value: str, date: str = "date"
) -> DataFrame:
    """Monthly mean of daily readings; missing readings are left out."""
    means = df.groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.avg(value).alias("monthly_mean_flow")
    )
    return means.withColumn("date", F.make_date("year", "month", F.lit(1)))


def gauge_against_model(
    gauge: DataFrame, model: DataFrame, first: int = 1980, last: int = 1999, value: str = "flow_cfs", date: str = "date"
) -> DataFrame:
    """Monthly means of a gauge and a model's months, one below the other: (date, flow, type)."""
    means = daily_to_monthly_mean(gauge.filter(in_years(date, first, last)), [], value, date)
    measured = means.select("date", F.col("monthly_mean_flow").alias("flow"), F.lit("gauge").alias("type"))
    months = model.filter(in_years(date, first, last)).select(
        F.trunc(date, "month").alias("date"), F.col(value).cast("double").alias("flow"), F.lit("model").alias("type")
    )
    return measured.unionByName(months)


def annual_volume(df: DataFrame, keys: Sequence[str], value: str = "flow_cfs") -> DataFrame:
    """Volume in acre-feet of the months of each key, also with thousands separators."""
    total = strict_sum(acre_feet(value))
    return df.groupBy(*keys).agg(total.alias("acre_feet")).withColumn(
        "acre_feet_text", F.format_number("acre_feet", 0)
    )


def fit_line(df: DataFrame, y: Column, x: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line as aggregates, so it combines before any shuffle."""
    rows = df.select(*keys, y.cast("double").alias("__y"), x.cast("double").alias("__x"))
    return rows.groupBy(*keys).agg(
        F.regr_slope("__y", "__x").alias("slope"),
        F.regr_intercept("__y", "__x").alias("intercept"),
        F.regr_r2("__y", "__x").alias("r2"),
        F.regr_count("__y", "__x").alias("n"),
    )


def fit_summary(df: DataFrame, y: Column, x: Column, keys: Sequence[str] = ()) -> DataFrame:
    """A least-squares line with its errors, t and p values, one row per group.

    ``slope, slope_error, slope_t, slope_p`` and the same of the intercept, then
    ``residual_error, r2, adjusted_r2, f, n``. From centred moments, which merge, so
    a hot group combines before its shuffle and values far from zero keep their
    digits. Pairs with a missing value are left out. Without a spread of x nothing
    is fitted; with two pairs a line has no errors.
    """
    rows = df.select(*keys, y.cast("double").alias("__y"), x.cast("double").alias("__x"))
    m = rows.groupBy(*keys).agg(
        F.regr_count("__y", "__x").alias("n"), F.regr_avgx("__y", "__x").alias("mx"), F.regr_avgy("__y", "__x").alias("my"),
        F.regr_sxx("__y", "__x").alias("xx"), F.regr_syy("__y", "__x").alias("yy"), F.regr_sxy("__y", "__x").alias("xy"),
    )
    n, xx, yy, xy = (F.col(c) for c in ("n", "xx", "yy", "xy"))
    free = n - 2
    m = m.withColumn("slope", F.try_divide(xy, xx)).withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
    rest = F.greatest(yy - F.col("slope") * xy, F.lit(0.0))
    m = m.withColumn("residual_error", F.when(free > 0, F.sqrt(F.try_divide(rest, free))))
    error = F.col("residual_error")
    m = m.withColumn("slope_error", error * F.sqrt(F.try_divide(F.lit(1.0), xx)))
    m = m.withColumn("intercept_error", error * F.sqrt(F.try_divide(F.lit(1.0), n) + F.try_divide(F.col("mx") * F.col("mx"), xx)))
    m = m.withColumn("r2", F.try_divide(xy * xy, xx * yy))
    out = [*keys]
    for name in ("slope", "intercept"):
        # An error of zero is an exact fit.
        t = F.when(F.col(f"{name}_error") == 0, F.signum(name) * float("inf")).otherwise(F.try_divide(F.col(name), F.col(f"{name}_error")))
        out += [name, f"{name}_error", t.alias(f"{name}_t"), student_p(t, free).alias(f"{name}_p")]
    adjusted = 1 - (1 - F.col("r2")) * F.try_divide(n - 1, free)
    f = F.try_divide(F.col("slope") * xy, error * error)
    return m.select(*out, "residual_error", "r2", F.when(free > 0, adjusted).alias("adjusted_r2"), f.alias("f"), "n")


def predict_line(df: DataFrame, fit: DataFrame, x: Column, threshold: float, out: str = "predicted") -> DataFrame:
    """Value on a fitted line from ``threshold`` on, 0 below; the fit is one scalar row."""
    line = fit.select(F.struct("slope", "intercept")).scalar()
    value = line.getField("slope") * x + line.getField("intercept")
    return df.withColumn(out, F.when(x >= threshold, value).otherwise(F.when(x.isNotNull(), F.lit(0.0))))


def grand_total(df: DataFrame, parts: Sequence[Column], out: str = "grand_total") -> DataFrame:
    """The sum of all parts over all rows, on every row (a scalar subquery)."""
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.withColumn(out, df.select(strict_sum(total)).scalar())


def nearest_to_median(
    years: DataFrame,
    classes: Sequence[str],
    keys: Sequence[str] = ("location",),
    within: float = 1.0,
    all_classes: bool = True,
) -> DataFrame:
    """Years whose index lies within a distance of the class median, nearest first.

    ``all_classes`` searches among the years of every class, as published;
    otherwise only among those of the class.
    """
    mine = F.col("year_type").isin(list(classes))
    median = years.filter(mine).groupBy(*keys).agg(F.median("idx").alias("median_idx"))
    pool = years if all_classes else years.filter(mine)
    near = pool.join(median, list(keys)).withColumn("distance", F.abs(F.col("idx") - F.col("median_idx")))
    return near.filter(F.col("distance") < within).orderBy(*keys, "distance", "year")


def year_class(
    year_type: Column | str, wet: Sequence[str] = ("Wet", "Above Normal"), labels: tuple[str, str] = ("wet", "dry")
) -> Column:
    """Wet and above-normal years against all others."""
    c = F.col(year_type) if isinstance(year_type, str) else year_type
    return F.when(c.isin(list(wet)), labels[0]).otherwise(labels[1])


def synthetic_series(
    year_types: DataFrame, template: DataFrame, value: str = "flow_cfs"
) -> DataFrame:
    """Each year takes the twelve months of its type's template, dated at month end."""
    return year_types.join(template, "year_type").withColumn("date", month_end_of("year", "month"))


def scale_thresholds(
    thresholds: DataFrame, ratios: DataFrame, column: str, out: str, digits: int = 0
) -> DataFrame:
    """Thresholds times the mean of a ratio column; halves round to the even neighbour."""
    factor = ratios.select(strict_mean("value")).scalar()
    return thresholds.withColumn(out, F.bround(F.col(column) * factor, digits))


def relabel(column: str, cases: Mapping[str, Sequence[str]]) -> Column:
    """``case_when``: values that belong to a listed set take its label."""
    out = F.col(column)
    for label, values in cases.items():
        out = F.when(F.col(column).isin(list(values)), F.lit(label)).otherwise(out)
    return out
