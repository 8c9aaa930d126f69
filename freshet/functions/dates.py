"""Calendar functions. A monthly value carries the last day of its month."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.missing import col

# Month names in calendar order.
MONTH_ABB = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_NAME = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
# Days in the months of a non-leap year, January first.
MONTH_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]

EXPORT_DATE = "ddMMMyyyy"


def month_end(x: Column | str) -> Column:
    return F.last_day(col(x))


def month_start(x: Column | str) -> Column:
    return F.trunc(col(x), "month")


def month_end_of(year: Column | str, month: Column | str) -> Column:
    """Last day of a month given as two numbers."""
    return F.last_day(F.make_date(col(year), col(month), F.lit(1)))


def days_in_month(x: Column | str) -> Column:
    return F.dayofmonth(F.last_day(col(x)))


def days_in_plain_month(month: Column | str) -> Column:
    """Days of a month number in a non-leap year."""
    return F.get(F.array(*[F.lit(d) for d in MONTH_DAYS]), col(month) - 1)


def parse_date(text: Column | str, fmt: str) -> Column:
    """A date, or NULL where the text does not follow the format."""
    return F.try_to_date(col(text), fmt)


def parse_short_year(text: Column | str, fmt: str = "M/d/yy") -> Column:
    """Two-digit years: 69-99 are 19xx, 00-68 are 20xx."""
    d = F.try_to_date(col(text), fmt)
    return F.when(F.year(d) > 2068, F.add_months(d, -1200)).otherwise(d)


def century_shift(x: Column | str) -> Column:
    """Undo a century misread: from October 2021 on, dates belong 100 years earlier."""
    d = month_end(x)
    return F.when(d >= F.lit(dt.date(2021, 10, 1)), F.last_day(F.add_months(d, -1200))).otherwise(d)


def century_shift_after(x: Column | str, last_year: int = 2003) -> Column:
    """The same for runs whose record ends in ``last_year``."""
    d = month_end(x)
    late = d >= F.lit(dt.date(last_year + 1, 1, 1))
    return F.when(late, F.last_day(F.add_months(d, -1200))).otherwise(d)


def water_year(x: Column | str) -> Column:
    """The water year runs October to September and is named for its end."""
    x = col(x)
    return F.year(x) + F.when(F.month(x) >= 10, 1).otherwise(0)


def water_month(x: Column | str) -> Column:
    """October is 1, September is 12."""
    return (F.month(col(x)) + 2) % 12 + 1


def water_year_shift(x: Column | str) -> Column:
    """October to December keep their date, the other months move one year on.

    A day that does not exist in the next year becomes that month's last day.
    """
    x = col(x)
    return F.when(F.month(x) >= 10, x).otherwise(F.add_months(x, 12))


def month_abb(month: Column | str) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTH_ABB]), col(month) - 1)


def month_index(name: Column | str) -> Column:
    """Number of a month given by its full or short English name, else NULL."""
    name = col(name)
    full = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAME]), name)
    short = F.array_position(F.array(*[F.lit(m) for m in MONTH_ABB]), name)
    return F.nullif(F.greatest(full, short), F.lit(0)).cast("int")


def in_years(x: Column | str, first: int, last: int) -> Column:
    """Year window as literal bounds, so that it can reach the scan."""
    x = col(x)
    return (x >= F.lit(dt.date(first, 1, 1))) & (x < F.lit(dt.date(last + 1, 1, 1)))


def in_months(x: Column | str, months: Iterable[int]) -> Column:
    return F.month(col(x)).isin(list(months))


def month_ends(first: int, last: int) -> list[dt.date]:
    """All month ends of a year window (driver side, for parameters)."""
    return [
        dt.date(y, m, calendar.monthrange(y, m)[1]) for y in range(first, last + 1) for m in range(1, 13)
    ]
