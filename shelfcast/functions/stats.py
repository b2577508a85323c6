"""The exact distribution of the Mann-Whitney statistic, for a row of statistics at a time.

The distributed work (grouping, ranking, sums) stays in Spark.
"""

from __future__ import annotations

import math

def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def mann_whitney_p(u1: float, n1: int, n2: int, tie_term: float) -> float:
    """Two-sided p of the Mann-Whitney U.

    Exact if one of the groups has at most 8 members and no value is tied, else normal with
    tie correction and continuity. `tie_term`: the sum of c**3 - c over the tied values.
    """
    u = max(u1, n1 * n2 - u1)
    if min(n1, n2) <= 8 and tie_term == 0:
        counts = _u_counts(n1, n2)
        return min(1.0, 2 * sum(counts[int(round(u)):]) / sum(counts))
    n = n1 + n2
    s = math.sqrt(n1 * n2 / 12.0 * ((n + 1) - tie_term / (n * (n - 1))))
    if s == 0:
        return 1.0
    return min(1.0, 2 * norm_sf((u - n1 * n2 / 2.0 - 0.5) / s))


def _u_counts(n1: int, n2: int) -> list[int]:
    """Number of arrangements giving each U = 0..n1*n2.

    The coefficients of the Gaussian binomial: the product over i = 1..min of
    (1 - q**(max + i)) / (1 - q**i), one factor at a time.
    """
    small, large = sorted((n1, n2))
    size = n1 * n2 + 1
    counts = [1] + [0] * (size - 1)
    for i in range(1, small + 1):
        for u in range(size - 1, large + i - 1, -1):
            counts[u] -= counts[u - large - i]
        for u in range(i, size):
            counts[u] += counts[u - i]
    return counts
