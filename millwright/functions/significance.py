"""Tail probabilities as column expressions, so that tests finish inside the plan."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

NORMAL_975 = 1.959963984540054
ROOT_PI = pi**0.5
#: Up to here 1 less the series keeps its digits; beyond it the fraction converges fast.
SERIES_UP_TO = 2.0
SERIES_TERMS, FRACTION_TERMS = 48, 72


def _series(x: Column) -> Column:
    """1 - erf(x) by the series of positive terms, summed from its end."""
    steps = F.sequence(F.lit(SERIES_TERMS), F.lit(1), F.lit(-1))
    total = F.aggregate(steps, F.lit(1.0), lambda so_far, n: so_far * (x * x * 2.0) / (n * 2 + 1) + 1.0)
    return F.lit(1.0) - total * x * F.exp(-x * x) * (2 / ROOT_PI)


def _fraction(x: Column) -> Column:
    """erfc(x) by its continued fraction, evaluated from its end."""
    steps = F.sequence(F.lit(FRACTION_TERMS), F.lit(1), F.lit(-1))
    return F.exp(-x * x) / (F.aggregate(steps, x, lambda below, n: x + n / 2 / below) * ROOT_PI)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, to about 13 digits at any size down to 1e-300."""
    return F.transform(F.array(x), lambda v: F.when(v < SERIES_UP_TO, _series(v)).otherwise(_fraction(v)))[0]


def two_sided_normal(z: Column) -> Column:
    """P(|Z| >= |z|) for a standard normal Z."""
    return erfc(F.abs(z) / (2.0**0.5))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """P(X >= x) for integer degrees of freedom, by the finite series for half-integer steps."""
    half = x / 2
    odd = dof % 2 == 1
    start = F.when(odd, erfc(F.sqrt(half))).otherwise(F.exp(-half))
    first = F.when(odd, F.sqrt(half) * 2 / (pi**0.5) * F.exp(-half)).otherwise(half * F.exp(-half))
    offset = F.when(odd, F.lit(1.5)).otherwise(F.lit(2.0))
    steps = F.floor((dof - 1) / 2).cast("int")
    folded = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.struct(start.alias("total"), first.alias("term"), offset.alias("order")),
        lambda acc, _: F.struct(
            (acc["total"] + acc["term"]).alias("total"),
            (acc["term"] * half / acc["order"]).alias("term"),
            (acc["order"] + 1.0).alias("order"),
        ),
        lambda acc: acc["total"],
    )
    return F.when(dof >= 1, folded)


def kolmogorov_tail(distance: Column, n1: Column, n2: Column) -> Column:
    """Limiting two-sample Kolmogorov-Smirnov p-value."""
    effective = n1.cast("double") * n2.cast("double") / (n1.cast("double") + n2.cast("double"))
    lam = F.sqrt(effective) * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
