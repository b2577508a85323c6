"""Direct multi-step forecast helpers (M-05, P-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blend(log_a: Column, log_b: Column, w_a: float = 0.3, w_b: float = 0.7) -> Column:
    """Weighted blend of two log-scale predictions, back to units, floored at 0."""
    return F.greatest(F.expm1(F.lit(w_a) * log_a + F.lit(w_b) * log_b), F.lit(0.0))
