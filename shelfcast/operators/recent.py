"""The last days of every series as one array: lags and rolling statistics of a direct forecast are places in it.

The state of a series is bounded by the longest lag, so the forecast's rows meet one row per
series; neither history and horizon are unioned, nor is the history read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import decimal_quotient
from shelfcast.spec import DEFAULT_PANEL, PanelSpec


def recent_days(history: DataFrame, start, days: int, spec: PanelSpec = DEFAULT_PANEL, out: str = "recent") -> DataFrame:
    """keys and `out`: the target of the `days` days before `start`, the latest first; a missing day is null.

    A day that stands several times counts with its largest value. Series without a day there are missing.
    """
    back = F.datediff(F.lit(start), F.col(spec.date))
    kept = history.where(back.between(1, days)).groupBy(*spec.key_cols, back.alias("_back")).agg(F.max(F.col(spec.target).cast("double")).alias("_v"))
    known = kept.groupBy(*spec.keys).agg(F.map_from_entries(F.collect_list(F.struct("_back", "_v"))).alias("_known"))
    return known.select(*spec.keys, F.transform(F.sequence(F.lit(1), F.lit(days)), lambda k: F.try_element_at("_known", k)).alias(out))


def lag_at(recent: str, ahead: Column, n: int) -> Column:
    """The value n days before the day that is `ahead` days (0: the first) into the horizon; null where that isn't history."""
    place = F.lit(n) - ahead
    return F.when(place >= 1, F.get(F.col(recent), place - 1))


def rolling_at(recent: str, ahead: Column, window: int, offset: int, stat: str, min_periods: int, decimals: int | None) -> Column:
    """Mean or sample deviation of the `window` days that end `offset` days before; days in the horizon are missing."""
    first = F.greatest(F.lit(offset) - ahead, F.lit(1))
    days = F.slice(F.col(recent), first, F.greatest(F.lit(offset + window) - ahead - first, F.lit(0)))
    values = F.filter(days, lambda v: v.isNotNull())
    n = F.size(values)
    if stat == "mean" and decimals is not None:
        kind = f"decimal(38,{decimals})"
        units = F.aggregate(values, F.lit(0).cast(kind), lambda a, v: (a + v.cast(kind)).cast(kind))
        found = decimal_quotient(units, n, decimals).cast("double")
    else:
        mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), n)
        found = mean if stat == "mean" else F.get(F.transform(F.array(mean), lambda m: F.sqrt(F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)), n - 1))), 0)
    return F.when(n >= min_periods, found)
