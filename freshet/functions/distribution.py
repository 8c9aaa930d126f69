"""Distribution functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; fewer than a hundred change the tenth digit.
TERMS = 200


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its last term back.

    The arguments are bound to a variable of a row: steps read them and do not evaluate them again.
    """

    def fraction(s: Column) -> Column:
        a, b, x = s["a"], s["b"], s["x"]

        def step(h: Column, m: Column) -> Column:
            # Term 2 m, then term 2 m - 1.
            back = m - 1
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = (a + back) * (a + b + back) * x / ((a + 2 * back) * (a + 2 * back + 1))
            return 1 - odd / (1 + even / h)

        pairs = F.sequence(F.lit(TERMS // 2), F.lit(1), F.lit(-1)).cast("array<double>")
        return 1 / F.aggregate(pairs, F.lit(1.0), step)

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"), x.alias("x"))), fraction)[0]


def _half_step(z: Column) -> Column:
    """ln gamma(z + 1/2) - ln gamma(z), by its series eight steps up."""
    up = z + 8
    series = F.ln(up) / 2 - 1 / (8 * up) + 1 / (192 * up**3) - 1 / (640 * up**5) + 17 / (14336 * up**7)
    for k in range(8):
        series = series + F.ln((z + k) / (z + k + 0.5))
    return series


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p value of Student's t with df degrees of freedom.

    The incomplete beta function on the side where its continued fraction converges
    fast; the tail itself is computed, so small values keep their digits. NULL
    without degrees of freedom or t; 0 for an infinite t.
    """
    a, b = df / 2, F.lit(0.5)
    v = F.try_divide(t * t, df + t * t)
    w = F.try_divide(df, df + t * t)
    front = F.exp(a * F.ln(w) + F.ln(v) / 2 - (math.log(math.pi) / 2 - _half_step(a)))
    near = w < (a + 1) / (a + 2.5)
    low, high = F.when(near, a).otherwise(b), F.when(near, b).otherwise(a)
    tail = front * _beta_fraction(low, high, F.when(near, w).otherwise(v)) / low
    value = F.when(near, tail).otherwise(1 - tail)
    return (
        F.when((df <= 0) | df.isNull() | t.isNull() | F.isnan(t), F.lit(None).cast("double"))
        .when((F.abs(t) == float("inf")) | (w == 0), 0.0)
        .when((t == 0) | (v == 0), 1.0)
        .otherwise(value)
    )
