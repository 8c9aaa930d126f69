"""Unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.missing import col

# Fixed values.
CMS_PER_CFS = 0.028316847
ACRE_FEET_PER_MONTH_PER_CFS = 60.3707
LOWER_MID_REACHES = (35.6 / 58, 22.4 / 58)


def cfs_to_cms(flow_cfs: Column | str) -> Column:
    """Cubic feet per second to cubic metres per second."""
    return col(flow_cfs) * F.lit(CMS_PER_CFS)


def acre_feet(flow_cfs: Column | str) -> Column:
    """Volume of a monthly mean flow."""
    return col(flow_cfs) * F.lit(ACRE_FEET_PER_MONTH_PER_CFS)


def weighted_blend(a: Column | str, b: Column | str, weights: tuple[float, float] = LOWER_MID_REACHES) -> Column:
    """Two reaches blended by their length."""
    return F.lit(weights[0]) * col(a) + F.lit(weights[1]) * col(b)
