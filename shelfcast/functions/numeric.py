"""Guarded arithmetic and rounding used across operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9  # fixed value: the reference's guard added to denominators


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_ratio(num, den) -> Column:
    """num / (den + 1e-9): the reference's zero guard."""
    return c(num) / (c(den) + F.lit(EPS))


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(c(num), c(den))


def rnd(x, digits: int = 6) -> Column:
    return F.round(c(x), digits)


def exact_sum(x) -> Column:
    """Order-independent double sum: add as decimal(38,6), return double."""
    return F.sum(c(x).cast("decimal(38,6)")).cast("double")


def decimal_mean(x, over=None, scale: int = 6) -> Column:
    """Mean of money values of `scale` (3 to 6) decimals, half-up to scale + 4 of them, as a decimal.

    Added as decimal(38,scale), so values up to 1e20 and their sums fit; independent of the
    order of addition, so every engine returns the same value. `over`: a window.
    """
    units, n = F.sum(c(x).cast(f"decimal(38,{scale})")), F.count(c(x))
    if over is not None:
        units, n = units.over(over), n.over(over)
    return decimal_quotient(units, n, scale)


def decimal_quotient(units: Column, n: Column, scale: int) -> Column:
    """units (decimal of `scale` digits) / n, half-up to scale + 4 digits; null where n is 0."""
    # a quotient of wide decimals keeps six digits behind the point: shift the others in front of it
    shift = scale - 2
    shifted = F.try_divide((units * F.lit(10**shift).cast("decimal(5,0)")).cast("decimal(34,2)"), n.cast("decimal(20,0)"))
    return shifted.cast("decimal(28,6)") * F.lit(f"{10**-shift:.{shift}f}").cast(f"decimal({shift},{shift})")


def exact_avg(x, digits: int = 4) -> Column:
    """`decimal_mean`, rounded half-up to `digits`, as double."""
    return F.round(decimal_mean(x), digits).cast("double")


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0, from built-in functions.

    Below 3 the series with positive terms, from 3 on the continued fraction from its tail.
    """
    z = z.cast("double")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, k: F.struct((a["term"] * 2 * z * z / (2 * k + 1)).alias("term"), (a["sum"] + a["term"] * 2 * z * z / (2 * k + 1)).alias("sum")),
    )["sum"]
    tail = F.aggregate(F.sequence(F.lit(60), F.lit(1)), z, lambda a, k: z + k / F.lit(2.0) / a)
    root = F.sqrt(F.lit(math.pi))
    return F.when(z < 3, 1 - 2 / root * F.exp(-z * z) * z * series).otherwise(F.exp(-z * z) / (root * tail))


def normal_sf(z: Column) -> Column:
    """Upper tail of the standard normal distribution."""
    half = erfc(F.abs(z) / F.sqrt(F.lit(2.0))) / 2
    return F.when(z < 0, 1 - half).otherwise(half)


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: the finite sums for even and for odd degrees of freedom."""
    x = x.cast("double")
    steps = F.sequence(F.lit(1), F.greatest(F.floor((dof - 1) / 2).cast("int"), F.lit(1)))

    def total(first: Column, odd: int) -> Column:
        grown = lambda a, k: F.struct((a["term"] * x / (2 * k + odd)).alias("term"), (a["sum"] + F.when(2 * k + 2 * odd < dof, a["term"] * x / (2 * k + odd)).otherwise(0.0)).alias("sum"))
        return F.aggregate(steps, F.struct(first.alias("term"), first.alias("sum")), grown)["sum"]

    even = F.exp(-x / 2) * total(F.lit(1.0), 0)
    root = F.sqrt(x)
    odd = erfc(F.sqrt(x / 2)) + F.when(dof > 1, F.sqrt(F.lit(2 / math.pi)) * F.exp(-x / 2) * total(root, 1)).otherwise(0.0)
    return F.when(x <= 0, 1.0).when(dof % 2 == 0, even).otherwise(odd)
