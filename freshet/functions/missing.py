"""Missing-value, zero-denominator and cap rules.

NULL is "missing". NaN and the infinities are ordinary double values that some
datasets keep, so every ratio names what becomes of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP = "keep"
NAN = float("nan")
INF = float("inf")


@dataclass(frozen=True)
class RatioPolicy:
    """What a ratio becomes outside the ordinary range.

    ``on_inf``/``on_neg_inf``: positive/negative numerator over zero.
    ``on_nan``: zero over zero. Each is ``KEEP``, a number, or ``None`` (missing).
    ``cap``: upper bound. ``on_null``: replacement for a missing result.
    ``digits``: rounding before all of these.
    """

    on_inf: float | str | None = KEEP
    on_neg_inf: float | str | None = KEEP
    on_nan: float | str | None = KEEP
    cap: float | None = None
    on_null: float | None = None
    digits: int | None = None

    def uncapped(self) -> RatioPolicy:
        return replace(self, cap=None)


# The zero-denominator, cap and fill rule of each published ratio dataset.
PLAIN = RatioPolicy()
DIVERTED_ROUNDED = RatioPolicy(on_inf=0.0, on_neg_inf=0.0, on_nan=0.0, cap=1.0, on_null=0.0, digits=6)
DIVERTED_CAPPED = RatioPolicy(on_inf=1.0, on_nan=0.0, cap=1.0, on_null=0.0)
# One place group of the capped family has no cap: its infinities survive.
DIVERTED_UNCAPPED = RatioPolicy(on_nan=0.0, on_null=0.0)
DIVERTED_CAP_FIRST = RatioPolicy(on_inf=1.0, on_neg_inf=0.0, on_nan=0.0, cap=1.0, on_null=0.0)
DELTA_NORTH = RatioPolicy()
DELTA_SOUTH = RatioPolicy(on_inf=1.0, on_nan=None, cap=1.0)
NATAL = RatioPolicy(on_inf=1.0, on_nan=None, cap=1.0, on_null=0.0)
PULSE_KEEP = RatioPolicy(on_inf=0.0, on_neg_inf=0.0)
PULSE_NAN_ZERO = RatioPolicy(on_inf=0.0, on_neg_inf=0.0, on_nan=0.0)
PULSE_FILL = RatioPolicy(on_inf=0.0, on_neg_inf=0.0, on_nan=0.0, on_null=0.0)
BYPASS_CAPPED = RatioPolicy(on_inf=1.0, cap=1.0)
BYPASS_OPEN = RatioPolicy()
SHARE_ZERO = RatioPolicy(on_inf=0.0, on_neg_inf=0.0, on_nan=0.0)

POLICIES = {
    "plain": PLAIN,
    "diverted_rounded": DIVERTED_ROUNDED,
    "diverted_capped": DIVERTED_CAPPED,
    "diverted_uncapped": DIVERTED_UNCAPPED,
    "diverted_cap_first": DIVERTED_CAP_FIRST,
    "delta_north": DELTA_NORTH,
    "delta_south": DELTA_SOUTH,
    "natal": NATAL,
    "pulse_keep": PULSE_KEEP,
    "pulse_nan_zero": PULSE_NAN_ZERO,
    "pulse_fill": PULSE_FILL,
    "bypass_capped": BYPASS_CAPPED,
    "bypass_open": BYPASS_OPEN,
    "share_zero": SHARE_ZERO,
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quotient(n: Column | str, d: Column | str) -> Column:
    """IEEE division: NULL in gives NULL, a zero denominator gives NaN or an infinity."""
    n, d = col(n), col(d)
    over_zero = (
        F.when((n == 0) | F.isnan(n), F.lit(NAN)).when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))
    )
    # try_divide never raises, so a re-ordered evaluation of the branches stays safe.
    return F.when(d == 0, over_zero).otherwise(F.try_divide(n, d))


def ratio(n: Column | str, d: Column | str, policy: RatioPolicy = PLAIN) -> Column:
    """``n / d`` under a policy."""
    return settle(quotient(n, d), policy)


def settle(x: Column | str, policy: RatioPolicy) -> Column:
    """A policy applied to an IEEE quotient that is already a column."""
    x = col(x)
    if policy.digits is not None:
        x = F.round(x, policy.digits)
    out = x
    if policy.cap is not None:
        # NaN compares greater than every number in Spark, hence the guard.
        out = F.when(~F.isnan(x) & (x > policy.cap), F.lit(float(policy.cap))).otherwise(out)
    for special, test in (
        (policy.on_nan, F.isnan(x)),
        (policy.on_neg_inf, x == -INF),
        (policy.on_inf, x == INF),
    ):
        if special != KEEP:
            value = F.lit(None).cast("double") if special is None else F.lit(float(special))
            out = F.when(test, value).otherwise(out)
    return out if policy.on_null is None else F.coalesce(out, F.lit(float(policy.on_null)))


def outcome(policy: RatioPolicy, x: float | None) -> float | None:
    """A policy applied to a value that is missing or not finite."""
    special = None
    if x is not None:
        special = policy.on_nan if x != x else policy.on_inf if x > 0 else policy.on_neg_inf
        if special == KEEP:
            special = x if policy.cap is None or not x > policy.cap else policy.cap
    special = policy.on_null if special is None else special
    return None if special is None else float(special)


def settle_all(x: Column | str, policies: Mapping[str, RatioPolicy]) -> dict[str, tuple[Column, Column]]:
    """Each policy's result where it is finite, and the name of its class.

    The value's class is told once. What a policy makes of a missing or infinite value is
    looked up by it in a literal list, so that many policies in one projection stay a
    small piece of generated code.
    """
    x = col(x)
    place = F.when(x.isNull(), 0).when(F.isnan(x), 1).when(x == -INF, 2).when(x == INF, 3).otherwise(4)
    out = {}
    for name, policy in policies.items():
        results = [outcome(policy, v) for v in (None, NAN, -INF, INF)]
        y = x if policy.digits is None else F.round(x, policy.digits)
        y = y if policy.cap is None else F.least(y, F.lit(float(policy.cap)))
        known = [r if r is not None and abs(r) < INF else None for r in results]
        kinds = [class_of(r) for r in results]
        special = F.get(F.array(*(F.lit(r).cast("double") for r in known)), place)
        out[name] = (
            F.when(place == 4, y).otherwise(special),
            F.get(F.array(*(F.lit(k) for k in [*kinds, "finite"])), place),
        )
    return out


def class_of(value: float | None) -> str:
    """The name that ``kind`` gives a value."""
    if value is None:
        return "missing"
    return "nan" if value != value else "inf" if value == INF else "-inf" if value == -INF else "finite"


def cap(x: Column | str, limit: float) -> Column:
    """Upper bound that keeps missing values missing and NaN as NaN."""
    x = col(x)
    return F.when(~F.isnan(x) & (x > limit), F.lit(float(limit))).otherwise(x)


def clamp_nonneg(x: Column | str) -> Column:
    """Negative and NaN become 0; missing stays missing."""
    x = col(x)
    return F.when(F.isnan(x) | (x < 0), F.lit(0.0)).otherwise(x)


def finite_or(x: Column | str, value: float) -> Column:
    """NaN, infinities and missing become ``value``."""
    x = col(x)
    bad = x.isNull() | F.isnan(x) | (x == INF) | (x == -INF)
    return F.when(bad, F.lit(float(value))).otherwise(x)


def kind(x: Column | str) -> Column:
    """Name of the value class: missing, nan, inf, -inf or finite."""
    x = col(x)
    return (
        F.when(x.isNull(), "missing")
        .when(F.isnan(x), "nan")
        .when(x == INF, "inf")
        .when(x == -INF, "-inf")
        .otherwise("finite")
    )


def finite(x: Column | str) -> Column:
    """The value where it is finite, else NULL."""
    x = col(x)
    return F.when(~F.isnan(x) & (x != INF) & (x != -INF), x)


def strict(agg: Column, over: Column | str) -> Column:
    """An aggregate that is missing as soon as one input is missing."""
    return F.when(F.count(F.lit(1)) == F.count(col(over)), agg)


def strict_sum(x: Column | str) -> Column:
    return strict(F.sum(col(x)), x)


def strict_mean(x: Column | str) -> Column:
    return strict(F.avg(col(x)), x)


def strict_sd(x: Column | str) -> Column:
    return strict(F.stddev_samp(col(x)), x)


def strict_median(x: Column | str) -> Column:
    """Exact median. Callers group by (place, month), so a group holds one value per year."""
    return strict(F.median(col(x)), x)


def strict_min(x: Column | str) -> Column:
    return strict(F.min(col(x)), x)


def strict_max(x: Column | str) -> Column:
    return strict(F.max(col(x)), x)
